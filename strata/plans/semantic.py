"""Semantic metrics layer.

A model declares logical tables (with keys), many-to-one relationships,
dimensions, facts and metrics as SQL expressions over ``table.column``
references, plus comments, synonyms and enum samples.  ``query`` compiles a
request into DataFrame operations:

* each metric belongs to one base (fact) table; per base table only the
  tables on the many-to-one path to the requested dimensions are joined
  (left joins to the "one" side never multiply rows), then
  ``groupBy(dimensions).agg(metrics)``;
* metrics of different base tables are aggregated separately at the shared
  dimensions and combined with a null-safe full outer join (fan-out safe);
* derived metrics are computed from the combined component columns last;
* a dimension not reachable from a requested metric's table is an error.

``to_sql`` emits the same plan as SQL text (used as the independent oracle).
Both paths evaluate the identical expression strings, which are written in
the SQL subset Spark and DuckDB share.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import with_scalar


def _sort_col(spec: str):
    parts = spec.split()
    c = F.col(parts[0])
    if len(parts) > 1 and parts[1].upper() == "DESC":
        return c.desc_nulls_last()
    return c.asc_nulls_last()


@dataclass
class Table:
    name: str
    frame: Callable[..., DataFrame]          # (spark, sf_dir) -> DataFrame
    sql: str                                 # SQL relation text (subquery or view name)
    key: Sequence[str] = ()
    comment: str = ""


@dataclass
class Relationship:
    """Many-to-one: ``left`` rows reference exactly one ``right`` row."""
    name: str
    left: str
    left_cols: Sequence[str]
    right: str
    right_cols: Sequence[str]


@dataclass
class Dimension:
    name: str
    table: str
    expr: str
    synonyms: Sequence[str] = ()
    samples: Sequence = ()
    comment: str = ""


@dataclass
class Fact:
    name: str
    table: str
    expr: str
    comment: str = ""


@dataclass
class Metric:
    name: str
    table: str
    expr: str                                 # aggregate expression; may reference facts as {fact}
    synonyms: Sequence[str] = ()
    comment: str = ""


@dataclass
class DerivedMetric:
    name: str
    expr: str                                 # expression over other metric names
    inputs: Sequence[str] = ()
    synonyms: Sequence[str] = ()
    comment: str = ""


@dataclass
class SemanticModel:
    name: str
    tables: Sequence[Table]
    relationships: Sequence[Relationship] = ()
    dimensions: Sequence[Dimension] = ()
    facts: Sequence[Fact] = ()
    metrics: Sequence[Metric] = ()
    derived: Sequence[DerivedMetric] = ()
    default_filters: Mapping[str, str] = field(default_factory=dict)   # table -> predicate
    comment: str = ""

    # ------------------------------------------------------------------ lookup
    def __post_init__(self):
        self._t = {t.name: t for t in self.tables}
        self._d = {d.name: d for d in self.dimensions}
        self._f = {f.name: f for f in self.facts}
        self._m = {m.name: m for m in self.metrics}
        self._dm = {m.name: m for m in self.derived}
        self._syn = {}
        for obj in list(self.dimensions) + list(self.metrics) + list(self.derived):
            self._syn[obj.name.lower()] = obj.name
            for s in obj.synonyms:
                self._syn[s.lower()] = obj.name
        self.validate_definition()

    def validate_definition(self):
        """SEM-01 checks: every referenced table exists; relationships point to declared keys."""
        for r in self.relationships:
            for t in (r.left, r.right):
                if t not in self._t:
                    raise ValueError(f"{self.name}: relationship {r.name} references unknown table {t}")
            if list(self._t[r.right].key) and list(r.right_cols) != list(self._t[r.right].key):
                raise ValueError(f"{self.name}: relationship {r.name} must target the key of {r.right}")
        for obj in list(self.dimensions) + list(self.facts) + list(self.metrics):
            if obj.table not in self._t:
                raise ValueError(f"{self.name}: {obj.name} references unknown table {obj.table}")

    def resolve(self, name: str) -> str:
        """SEM-09 synonym lookup."""
        try:
            return self._syn[name.lower()]
        except KeyError:
            raise KeyError(f"{self.name}: unknown metric or dimension {name!r}") from None

    def check_filter(self, dim: str, values) -> None:
        """SEM-08 enum dimension check: filter values must be declared samples."""
        d = self._d[self.resolve(dim)]
        if d.samples:
            bad = [v for v in values if v not in d.samples]
            if bad:
                raise ValueError(f"{self.name}: {bad} not among declared values of {d.name}: {list(d.samples)}")

    def _metric_expr(self, m: Metric) -> str:
        return m.expr.format(**{f: f"({self._f[f].expr})" for f in self._f})

    def path(self, base: str, target: str) -> list[Relationship]:
        """Many-to-one join path from ``base`` to ``target`` (BFS); SEM-04 multi-hop."""
        if base == target:
            return []
        seen, q = {base}, deque([(base, [])])
        while q:
            t, p = q.popleft()
            for r in self.relationships:
                if r.left == t and r.right not in seen:
                    if r.right == target:
                        return p + [r]
                    seen.add(r.right)
                    q.append((r.right, p + [r]))
        raise ValueError(f"{self.name}: dimension table {target} is not reachable from {base} (SEM-10)")

    # ------------------------------------------------------------------ planning
    def _plan(self, metrics: Sequence[str], dims: Sequence[str], filters: Sequence[str] = ()):
        """Per fact table: its metrics and the relationships that the dimensions and filters need;
        a dimension or filter that a fact can't reach raises (SEM-10)."""
        metrics = [self.resolve(m) for m in metrics]
        dims = [self.resolve(d) for d in dims]
        base_metrics: list[str] = []
        for m in metrics:
            if m in self._dm:
                base_metrics += [i for i in self._dm[m].inputs if i not in base_metrics]
            elif m not in base_metrics:
                base_metrics.append(m)
        by_table: dict[str, list[Metric]] = {}
        for m in base_metrics:
            mm = self._m[m]
            by_table.setdefault(mm.table, []).append(mm)
        plans = []
        for base, ms in by_table.items():
            rels: list[Relationship] = []
            for d in [*dims, *(self.resolve(f) for f in filters)]:
                for r in self.path(base, self._d[d].table):
                    if r not in rels:
                        rels.append(r)
            plans.append((base, ms, rels))
        return metrics, dims, plans

    # ------------------------------------------------------------------ Spark
    def query(self, spark, sf_dir: str, metrics: Sequence[str], dims: Sequence[str] = (),
              filters: Mapping[str, Sequence] | None = None, where: str | None = None,
              order: Sequence[str] = (), limit: int | None = None, apply_defaults: bool = False) -> DataFrame:
        """SEM-02/03 compile and run a metrics query; returns dims + metrics columns."""
        filters = filters or {}
        metrics, dims, plans = self._plan(metrics, dims, filters)
        for dname, vals in filters.items():
            self.check_filter(dname, vals)
        parts = []
        for base, ms, rels in plans:
            df = self._t[base].frame(spark, sf_dir).alias(base)
            for r in rels:
                right = self._t[r.right].frame(spark, sf_dir).alias(r.right)
                cond = None
                for lc, rc in zip(r.left_cols, r.right_cols):
                    c = F.col(f"{r.left}.{lc}") == F.col(f"{r.right}.{rc}")
                    cond = c if cond is None else cond & c
                df = df.join(right, cond, "left")
            if apply_defaults and base in self.default_filters:
                df = df.where(F.expr(self.default_filters[base]))
            for dname, vals in filters.items():
                df = df.where(F.expr(self._d[self.resolve(dname)].expr).isin(list(vals)))
            if where:
                df = df.where(F.expr(where))
            aggs = [F.expr(self._metric_expr(m)).alias(m.name) for m in ms]
            g = df.groupBy(*[F.expr(self._d[d].expr).alias(d) for d in dims]).agg(*aggs) if dims else df.agg(*aggs)
            parts.append(g)
        out = parts[0]
        for p in parts[1:]:
            if dims:
                cond = None
                for d in dims:
                    c = out[d].eqNullSafe(p[d])
                    cond = c if cond is None else cond & c
                j = out.join(p, cond, "full")
                keep = [F.coalesce(out[d], p[d]).alias(d) for d in dims]
                out = j.select(*keep, *[out[c] for c in out.columns if c not in dims],
                               *[p[c] for c in p.columns if c not in dims])
            else:
                out = with_scalar(out, p)  # both sides are 1-row totals
        for m in metrics:
            if m in self._dm:
                out = out.withColumn(m, F.expr(self._dm[m].expr))
        out = out.select(*dims, *metrics)
        if order:
            out = out.orderBy(*[_sort_col(o) for o in order])
        if limit is not None:
            out = out.limit(limit)
        return out

    def grain_dim(self, time_dim: str, grain: str = "month") -> str:
        """Register (once) a truncated-time dimension such as ``sale_date_month``."""
        d = self._d[self.resolve(time_dim)]
        name = f"{d.name}_{grain}"
        if name not in self._d:
            self._d[name] = Dimension(name, d.table, f"CAST(date_trunc('{grain}', {d.expr}) AS DATE)")
            self._syn[name.lower()] = name
        return name

    def trend(self, spark, sf_dir: str, metric: str, time_dim: str, grain: str = "month",
              dims: Sequence[str] = (), digits: int = 2) -> DataFrame:
        """SEM-11 trend defaults: monthly grain, money rounded to 2 decimals."""
        g = self.grain_dim(time_dim, grain)
        out = self.query(spark, sf_dir, [metric], [g, *dims])
        m = self.resolve(metric)
        scale = float(10 ** digits)
        # half-up rounding as floor(x * 10^d + 0.5) / 10^d (identical in every engine)
        # after snapping the sum at 1e-6 (summation-order noise)
        snapped = F.floor(F.col(m) * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6)
        return out.withColumn(m, F.floor(snapped * F.lit(scale) + F.lit(0.5)) / F.lit(scale))

    # ------------------------------------------------------------------ SQL
    def to_sql(self, metrics: Sequence[str], dims: Sequence[str] = (), filters: Mapping[str, Sequence] | None = None,
               where: str | None = None, order: Sequence[str] = (), limit: int | None = None,
               apply_defaults: bool = False, roles_sql: str = "") -> str:
        filters = filters or {}
        metrics, dims, plans = self._plan(metrics, dims, filters)
        ctes = []
        for i, (base, ms, rels) in enumerate(plans):
            frm = f"{self._t[base].sql} AS {base}"
            for r in rels:
                on = " AND ".join(f"{r.left}.{lc} = {r.right}.{rc}" for lc, rc in zip(r.left_cols, r.right_cols))
                frm += f" LEFT JOIN {self._t[r.right].sql} AS {r.right} ON {on}"
            preds = []
            if apply_defaults and base in self.default_filters:
                preds.append(self.default_filters[base])
            for dname, vals in filters.items():
                preds.append(f"({self._d[self.resolve(dname)].expr}) IN (" + ", ".join(repr(v) for v in vals) + ")")
            if where:
                preds.append(where)
            sel = [f"{self._d[d].expr} AS {d}" for d in dims] + [f"{self._metric_expr(m)} AS {m.name}" for m in ms]
            sql = f"SELECT {', '.join(sel)} FROM {frm}"
            if preds:
                sql += " WHERE " + " AND ".join(f"({p})" for p in preds)
            if dims:
                sql += " GROUP BY " + ", ".join(str(k + 1) for k in range(len(dims)))
            ctes.append((f"_p{i}", sql, [m.name for m in ms]))
        head = ctes[0][0]
        frm, cols = head, {c: f"{head}.{c}" for c in ctes[0][2]}
        for name, _, ms in ctes[1:]:
            if dims:
                on = " AND ".join(f"{head}.{d} IS NOT DISTINCT FROM {name}.{d}" for d in dims)
                frm += f" FULL OUTER JOIN {name} ON {on}"
            else:
                frm += f" CROSS JOIN {name}"
            cols.update({c: f"{name}.{c}" for c in ms})
        dsel = [f"coalesce({', '.join(f'{c[0]}.{d}' for c in ctes)}) AS {d}" for d in dims]
        comb = f"SELECT {', '.join(dsel + [f'{v} AS {k}' for k, v in cols.items()])} FROM {frm}"
        outer = []
        for m in metrics:
            outer.append(f"{self._dm[m].expr} AS {m}" if m in self._dm else m)
        with_ = ", ".join(f"{n} AS ({s})" for n, s, _ in ctes)
        if roles_sql:
            with_ = roles_sql + ", " + with_
        sql = f"WITH {with_}, _c AS ({comb}) SELECT {', '.join(list(dims) + outer)} FROM _c"
        if order:
            sql += " ORDER BY " + ", ".join(order)
        if limit is not None:
            sql += f" LIMIT {limit}"
        return sql
