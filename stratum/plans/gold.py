"""Silver -> gold star schema.

Inputs: ``silver["anime"]`` (entity, every batch upserted in) and
``silver["links_anime_<kind>"]`` for the six link kinds.  Output: a dict of the
16 gold frames, all lazy:

  f_anime                 latest batch of the entity, duration in minutes, and
                          the three surrogate ids found by their string value
  d_sources/statuses/types  ids 1..n over the sorted distinct non-null values
  d_<kind>                distinct (id, name) of each link kind (all batches)
  links_<kind>            (anime_id, X_id) of each link kind (all batches)

Building a frame that needs a surrogate-key dimension runs one job (the
checkpoint of the numbered values); everything else is lazy.  Dimensions are
plain equi-joins for the consumers: their size is only known once the distinct
has run, so the broadcast decision is Spark's (size-checked at plan time and
again by AQE on the real shuffle output).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.duration import duration_minutes
from ..operators.sequence import dense_index


def surrogate_dim(entity: DataFrame, column: str, id_col: str) -> DataFrame:
    """(id_col bigint, column): ids 1..n over sorted distinct non-null values."""
    return surrogate_dims(entity, [(column, id_col)])[column]


def surrogate_dims(entity: DataFrame, specs: list[tuple[str, str]]) -> dict[str, DataFrame]:
    """Several surrogate-key dimensions from one pass over the entity.

    The distinct non-null values of the columns, exploded as (dim, value) in a
    single scan, are numbered by the distributed ``dense_index`` (which runs its
    checkpoint job here) and renumbered from 1 in each dimension.  The path is
    the same for every number of values.
    """
    types = {entity.schema[c].dataType.simpleString() for c, _ in specs}
    if len(types) > 1:
        # values are ordered in their own type, so only same-typed columns share a pass
        out: dict[str, DataFrame] = {}
        for t in sorted(types):
            out.update(surrogate_dims(entity, [sp for sp in specs
                                               if entity.schema[sp[0]].dataType.simpleString() == t]))
        return out
    pairs = F.array(*[F.struct(F.lit(k).alias("__dim"), F.col(c).alias("__v")) for k, (c, _) in enumerate(specs)])
    values = (entity.select(F.explode(pairs).alias("x")).select("x.*")
              .where(F.col("__v").isNotNull()).distinct())
    numbered = dense_index(values, ["__dim", "__v"], "__n")
    firsts = numbered.groupBy("__dim").agg(F.min("__n").alias("__first"))
    # one row per dimension in ``firsts``: a proven bound for the broadcast
    based = (numbered.join(F.broadcast(firsts), "__dim")
             .withColumn("__id", (F.col("__n") - F.col("__first") + 1).cast("bigint")))
    return {column: based.where(F.col("__dim") == k).select(F.col("__id").alias(id_col), F.col("__v").alias(column))
            for k, (column, id_col) in enumerate(specs)}


def natural_dim(links: DataFrame, prefix: str) -> DataFrame:
    i, n = S.link_cols(prefix)
    return links.select(i, n).distinct()


def gold_links(links: DataFrame, prefix: str, sort: bool = False) -> DataFrame:
    """(anime_id, X_id).  ``sort`` range-partitions and sorts by both keys, the
    layout of the stored table (a total order without a single-task sort)."""
    i, _ = S.link_cols(prefix)
    out = links.select("anime_id", i)
    if sort:
        out = out.repartitionByRange("anime_id", i).sortWithinPartitions("anime_id", i)
    return out


def latest_batch(entity: DataFrame) -> DataFrame:
    """Rows of the highest batch; the max is an uncorrelated scalar subquery."""
    return entity.where(F.col("batch_id") == entity.select(F.max("batch_id")).scalar())


def fact(entity: DataFrame, dims: Mapping[str, DataFrame], strict: bool = True,
         lookups: list[str] | None = None) -> DataFrame:
    """Latest batch with duration minutes and surrogate ids.  ``lookups`` names
    the columns whose ids are wanted (default all); the others are left out."""
    out = latest_batch(entity).withColumn(
        "duration_minutes_per_episode", duration_minutes("duration", strict))
    skipped = []
    for dim_name, column in S.SURROGATE_DIMS:
        if lookups is None or column in lookups:
            out = out.join(dims[dim_name], on=column, how="left")
        else:
            skipped.append(f"{column}_id")
    return out.select(*[c for c in S.FACT_COLUMNS if c not in skipped])


class LazyFrames(Mapping):
    """Name -> DataFrame, each built on first access and then kept.

    The surrogate dimensions run a (small) checkpoint job when built; a caller
    that only needs, say, the genre tables should not pay for them.
    """

    def __init__(self, factories: dict[str, Callable[[], DataFrame]],
                 fact_with: Callable[[list[str]], DataFrame] | None = None):
        self._factories = factories
        self._fact_with = fact_with
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._factories[name]()
        return self._built[name]

    def fact_with(self, lookups: list[str]) -> DataFrame:
        """The fact with only the surrogate ids of ``lookups``."""
        return self._fact_with(lookups)

    def __iter__(self):
        return iter(self._factories)

    def __len__(self) -> int:
        return len(self._factories)


def build_gold(silver: Mapping[str, DataFrame], strict: bool = True,
               sort_links: bool = False) -> LazyFrames:
    """The 16 gold frames (fewer when link kinds are missing from ``silver``)."""
    f: dict[str, Callable[[], DataFrame]] = {}
    gold = LazyFrames(f, lambda lookups: fact(silver["anime"], gold, strict, lookups))
    dims: dict[str, DataFrame] = {}

    def surrogate(column: str) -> DataFrame:
        if not dims:
            dims.update(surrogate_dims(silver["anime"], [(c, f"{c}_id") for _, c in S.SURROGATE_DIMS]))
        return dims[column]

    for dim_name, column in S.SURROGATE_DIMS:
        f[dim_name] = (lambda c=column: surrogate(c))
    f["f_anime"] = lambda: fact(silver["anime"], gold, strict)
    for kind, prefix in S.LINK_KINDS:
        name = f"links_anime_{kind}"
        if name not in silver:
            continue
        f[f"d_{kind}"] = (lambda n=name, p=prefix: natural_dim(silver[n], p))
        f[f"links_{kind}"] = (lambda n=name, p=prefix: gold_links(silver[n], p, sort_links))
    return gold
