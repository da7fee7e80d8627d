"""One ordered run over all destinations: stage once, write six tables, check, publish."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from rawstar import layout
from rawstar.operators import scope as scopes
from rawstar.operators.manifest import row_counters
from rawstar.plans import recipes, staging
from rawstar.session import materialize

# Destinations in run order (a later one may read an earlier one).
RUN_ORDER = ["table3", "table4", "table1", "table5", "table6", "table2"]


@dataclass
class Star:
    """Lazy outputs of one run. ``source`` is the staging table they all read."""

    source: DataFrame
    tables: dict[str, DataFrame] = field(default_factory=dict)

    def row_counts(self) -> DataFrame:
        """(destination, row_count), zero rows included."""
        return row_counters(self.tables).withColumnRenamed("table_name", "destination")


def _children(
    source_of: Callable[[str], DataFrame], table3: DataFrame, table4: DataFrame
) -> dict[str, DataFrame]:
    """The four destinations whose rows need a reference row."""
    recipe = {
        "table1": recipes.fact_main,
        "table5": recipes.child_measure,
        "table6": lambda rows: recipes.bridge_code(rows, table4),
        "table2": recipes.unpivot_positions,
    }
    matched: dict[DataFrame, DataFrame] = {}  # one stored source is matched once
    outputs = {}
    for name, build in recipe.items():
        source = source_of(name)
        if source not in matched:
            matched[source] = recipes.match_reference(source, table3)
        outputs[name] = build(matched[source])
    return outputs


def sources_of(raw_table: DataFrame) -> Callable[[str], DataFrame]:
    """Unstored staging: each destination parses just the headers it reads."""
    sources = {name: staging.stage(raw_table, staging.recipe_uses(name)) for name in RUN_ORDER}
    return sources.__getitem__


def plan_star(raw_table: DataFrame, scope: list[str] | None = None, stored: bool = True) -> Star:
    """The six destinations of the scoped raw rows.

    ``stored`` writes the staging table first, so that six recipes do not parse
    the payload six times. The matched fact rows carry the staged columns, so no
    child recipe shuffles on ``raw_id``.
    """
    scoped = raw_table if scope is None else scopes.in_scope(raw_table, scope)
    source = staging.stage(scoped)
    if stored:
        source = materialize(source, "staging")
        source_of = lambda name: source
    else:
        source_of = sources_of(scoped)
    table3, table4 = recipes.dim_reference(source_of("table3")), recipes.dim_code(source_of("table4"))
    if stored:
        table3, table4 = materialize(table3, "references"), materialize(table4, "codes")
    tables = {"table3": table3, "table4": table4, **_children(source_of, table3, table4)}
    return Star(source, {name: tables[name] for name in RUN_ORDER})


def _write_together(builders: dict[str, Callable[[], DataFrame]], path_of: Callable[[str], str]) -> None:
    """Write independent destinations as concurrent jobs, so that a short one leaves no executor idle."""

    def write(name: str) -> None:
        builders[name]().write.mode("overwrite").parquet(path_of(name))

    with ThreadPoolExecutor(len(builders)) as pool:
        for done in [pool.submit(write, name) for name in builders]:
            done.result()


def write_star(source_of: Callable[[str], DataFrame], path_of: Callable[[str], str]) -> None:
    """Write the six destinations: both dimensions, then the rest.

    ``source_of`` gives the staging table of a destination. The dimensions are
    read back from where they were written, so the joins know their true size.
    """
    _write_together(
        {
            "table3": lambda: recipes.dim_reference(source_of("table3")),
            "table4": lambda: recipes.dim_code(source_of("table4")),
        },
        path_of,
    )
    spark = source_of("table3").sparkSession
    table3, table4 = (
        spark.read.schema(layout.DESTINATION_COLUMNS[name]).parquet(path_of(name)) for name in ("table3", "table4")
    )
    children = _children(source_of, table3, table4)
    _write_together({name: lambda df=df: df for name, df in children.items()}, path_of)
