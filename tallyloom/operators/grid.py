"""Request grid, parameterised report query and measure dictionary."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.plans.specs import ReportSpec


def _literal_structs(rows: Sequence[dict]) -> Column:
    return F.array(*[F.struct(*[_literal(v).alias(k) for k, v in row.items()]) for row in rows])


def _literal(v) -> Column:
    if isinstance(v, dict):
        return F.struct(*[_literal(x).alias(k) for k, x in v.items()])
    if isinstance(v, (list, tuple)):
        return F.array(*[_literal(x) for x in v])
    return F.lit(v)


def request_grid(base: DataFrame, **dimensions: Sequence[dict]) -> DataFrame:
    """Every combination of the base rows and the configured lists.

    The lists are literals that each base row explodes, so no join is planned. Every entry of a dimension is a dict of
    columns; all entries of one dimension share the same keys.
    """
    for name, rows in dimensions.items():
        columns = list(rows[0])
        base = base.withColumn(f"_{name}", F.explode(_literal_structs(rows)))
        base = base.select(*[c for c in base.columns if c != f"_{name}"], *[f"_{name}.{c}" for c in columns])
    return base


def with_request_id(grid: DataFrame, report: str, keys: Sequence[str]) -> DataFrame:
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return grid.withColumn("request_id", F.concat_ws("|", F.lit(report), *parts))


def report_query(
    fact: DataFrame,
    equals: dict[str, object] | None = None,
    members: dict[str, Sequence] | None = None,
    member_sets: dict[str, DataFrame] | None = None,
    measures: Sequence | None = None,
    measure_column: str = "metric_id",
) -> DataFrame:
    """Filters and a measure list over a fact table.

    ``equals`` and ``members`` become scan predicates; ``member_sets`` restricts a column to the values of a frame
    with the same column (a media set), by semi join.
    """
    tests = [F.col(c) == F.lit(v) for c, v in (equals or {}).items()]
    tests += [F.col(c).isin(*v) for c, v in (members or {}).items()]
    if measures is not None:
        tests.append(F.col(measure_column).isin(*[str(m) for m in measures]))
    if tests:
        fact = fact.filter(reduce(lambda a, b: a & b, tests))
    for column, allowed in (member_sets or {}).items():
        fact = fact.join(allowed.select(column).distinct(), column, "left_semi")
    return fact


def request_parameters(spec: ReportSpec, period_id: int, **chosen: object) -> dict[str, object]:
    """All parameters of one request: the report's fixed ones and its options, the period and what the caller chose.

    ``chosen`` uses the parameter names of the report surface, such as timeType, mediaSet, csMarket or target.
    """
    return {**dict(spec.parameters), **{o: True for o in spec.options}, "timePeriod": period_id, **chosen}


def ask(
    fact: DataFrame, spec: ReportSpec, parameters: dict[str, object], columns: dict[str, str],
    media_set: DataFrame | None = None, measures: Sequence | None = None,
) -> DataFrame:
    """Answer one report request from a fact table.

    ``columns`` names the fact column behind each parameter; a parameter with a list of values (media, mediaColumn)
    tests membership. The report's own fixed parameters may be without a column, as they are constant over its fact; any
    other parameter without one is an error, since it would silently filter nothing. A requested ``mediaSet`` is answered by
    ``media_set``, its members in the fact's own media column. ``measures`` is the configured list, such as
    ``load_config`` reads it; without it the report's fixed list holds.
    """
    fixed = dict(spec.parameters) | {o: True for o in spec.options}
    by_members = {"mediaSet", "mediaSetType"} if media_set is not None else set()
    unknown = [p for p, v in parameters.items() if p not in columns and p not in by_members and not (p in fixed and fixed[p] == v)]
    if unknown:
        raise ValueError(f"no column for the parameters {unknown}")
    lists = {columns[p]: v for p, v in parameters.items() if p in columns and isinstance(v, (list, tuple))}
    equals = {columns[p]: v for p, v in parameters.items() if p in columns and columns[p] not in lists}
    sets = {} if media_set is None else {media_set.columns[0]: media_set}
    return report_query(fact, equals, lists, sets, spec.measures if measures is None else measures)


def decorate_measures(fact: DataFrame, dictionary: dict[str, str], column: str = "metric_id") -> DataFrame:
    """Add the measure's name from its id and say whether the id is known."""
    names = F.create_map(*[F.lit(x) for pair in dictionary.items() for x in pair])
    name = F.try_element_at(names, F.col(column))
    return fact.withColumns({"metric_name": name, "is_known": name.isNotNull()})
