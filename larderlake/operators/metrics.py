"""Metric views: named dimensions and measures over a source, aggregated at the grain asked for."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Widget:
    """What one widget of a dashboard asks of a view; see ``MetricView.query``."""

    dims: Sequence[str] = ()
    measures: Sequence[str] = ()
    where: str | None = None


WIDGET = "widget"


@dataclass(frozen=True)
class MetricView:
    """A dimension or measure is a SQL expression over the source; columns are dimensions too."""

    source: DataFrame
    dims: Mapping[str, str] = field(default_factory=dict)
    measures: Mapping[str, str] = field(default_factory=dict)

    def _dim(self, name: str):
        return F.expr(self.dims.get(name, f"`{name}`")).alias(name)

    def query(
        self,
        dims: Sequence[str] = (),
        measures: Sequence[str] = (),
        where: str | None = None,
        order_by: Mapping[str, str] | None = None,
    ) -> DataFrame:
        """Measures per combination of ``dims``; a single row without dims.

        ``where`` filters source rows. ``order_by`` maps result columns to ``"asc"``/``"desc"``.
        """
        rows = self.source.filter(where) if where else self.source
        values = [F.expr(self.measures[m]).alias(m) for m in measures]
        out = rows.groupBy(*map(self._dim, dims)).agg(*values)
        return _ordered(out, order_by)

    def queries(self, widgets: Mapping[str, Widget]) -> DataFrame:
        """All widgets of a dashboard in one pass over the source.

        One aggregation by grouping sets, a set for each grain asked for. A row belongs to the widget
        it names; the columns of other widgets are NULL. ``pick`` gives one widget's result.
        """
        named = {d for w in widgets.values() for d in w.dims}
        dims = sorted(named)
        grains = sorted({tuple(d for d in dims if d in w.dims) for w in widgets.values()})
        wheres = sorted({w.where for w in widgets.values() if w.where})
        # A filter of its own becomes a column, so that each measure reads only its widget's rows.
        rows = self.source.select(
            "*",
            *(self._dim(d).alias(f"__d{i}") for i, d in enumerate(dims)),
            *(F.coalesce(F.expr(w), F.lit(False)).alias(f"__w{i}") for i, w in enumerate(wheres)),
        )
        column = {d: f"__d{i}" for i, d in enumerate(dims)}
        asked = {(m, w.where) for w in widgets.values() for m in w.measures}
        values = {key: f"__m{i}" for i, key in enumerate(sorted(asked, key=str))}
        bits = {d: 1 << (len(dims) - 1 - i) for i, d in enumerate(dims)}

        def value(measure: str, where: str | None) -> Column:
            text = self.measures[measure]
            return F.expr(text if where is None else _only_where(text, f"__w{wheres.index(where)}"))

        sums = [value(*key).alias(name) for key, name in values.items()]
        sums += [F.count_if(f"__w{i}").alias(f"__n{i}") for i in range(len(wheres))]
        if dims:
            sets = [[F.col(column[d]) for d in grain] for grain in grains]
            by = rows.groupingSets(sets, *(F.col(column[d]) for d in dims))
            found = by.agg(F.grouping_id().cast("int").alias("__grain"), *sums)
        else:
            found = rows.agg(F.lit(0).alias("__grain"), *sums)
        measures = sorted({m for w in widgets.values() for m in w.measures})
        kinds = found.schema
        lines = []
        for name, w in widgets.items():
            grain = sum(bit for d, bit in bits.items() if d not in w.dims)
            here = F.col("__grain") == grain
            if w.where and w.dims:
                here &= F.col(f"__n{wheres.index(w.where)}") > 0
            fields = [F.lit(name).alias(WIDGET)]
            for d in dims:
                kept = F.col(column[d]) if d in w.dims else F.lit(None)
                fields.append(kept.cast(kinds[column[d]].dataType).alias(d))
            for m in measures:
                kind = next(kinds[v].dataType for (measure, _), v in values.items() if measure == m)
                kept = F.col(values[m, w.where]) if m in w.measures else F.lit(None)
                fields.append(kept.cast(kind).alias(m))
            lines.append(F.when(here, F.struct(*fields)))
        return found.select(F.inline(F.array_compact(F.array(*lines))))

    @staticmethod
    def pick(found: DataFrame, name: str, widget: Widget, order_by: Mapping[str, str] | None = None) -> DataFrame:
        """One widget's columns and rows."""
        return _ordered(found.filter(F.col(WIDGET) == name).select(*widget.dims, *widget.measures), order_by)

    def rows(
        self,
        fields: Sequence[str],
        where: str | None = None,
        order_by: Mapping[str, str] | None = None,
    ) -> DataFrame:
        """Row-level projection of dimensions, not aggregated."""
        rows = self.source.filter(where) if where else self.source
        return _ordered(rows.select(*map(self._dim, fields)), order_by)


def _only_where(measure: str, flag: str) -> str:
    """The measure with every aggregate restricted to rows that have the flag."""
    return re.sub(
        r"\b(count|sum|avg|min|max)\((?:[^()]|\([^()]*(?:\([^()]*\)[^()]*)*\))*\)",
        lambda call: f"{call.group(0)} FILTER (WHERE {flag})",
        measure,
        flags=re.IGNORECASE,
    )


def _ordered(df: DataFrame, order_by: Mapping[str, str] | None) -> DataFrame:
    if not order_by:
        return df
    keys = [F.desc(c) if way == "desc" else F.asc(c) for c, way in order_by.items()]
    return df.orderBy(*keys)
