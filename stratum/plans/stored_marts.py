"""Marts kept as partial sums per silver bucket, refreshed where a bucket has changed.

Every silver table is dealt to the same buckets by the title, so a title and all its
links are in one bucket and a bucket's share of any mart can be summed by itself:

  partials   (bucket, mart, batch_id, year, key) -> sums of the titles' weights w, and of
             w * x and w-where-x-is-known for members, score and popularity
  names      (bucket, kind, id, name) as the bucket's links spell them

A mart is then a sum over a table as small as its groups are few, whatever the number
of titles.  ``refresh`` compares the folder of each silver bucket (see
``sources.bucket_store``) with the one its partials were made from and computes the
changed buckets only; the others are not read.

Two things reach across buckets.  The fact is the latest batch: partials are kept by
batch and the marts choose.  And a link's weight counts the names of its id, so an id
of a weighing kind that has got another name changes titles anywhere: ids with several
names are fingerprinted, and if they are others than before all buckets are computed
again.

The tables' versions are looked up one after the other; a refresh during an upsert may
mix them, records what it has read, and the next one puts it right.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..operators.shares import share_of_total
from ..operators.topk import top_k
from ..sources.bucket_store import BUCKET, BucketStore

#: link kinds whose rows multiply a title in the enriched frame
WEIGHING = ("licensors", "genres")
#: link kinds that are grouped by
KINDS = ("genres", "licensors", "studios", "producers")
MEASURES = ("members", "score", "popularity")


def _schema(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, t) for name, t in types.items()])


_PARTIALS = _schema(
    mart=T.StringType(), batch_id=T.IntegerType(), year=T.IntegerType(), key=T.StringType(), n=T.LongType(),
    members=T.DecimalType(38, 0), members_n=T.LongType(), score=T.DoubleType(), score_n=T.LongType(),
    popularity=T.DoubleType(), popularity_n=T.LongType())
_NAMES = _schema(kind=T.StringType(), id=T.StringType(), name=T.StringType())


def _sums() -> list[Column]:
    out = [F.sum("w").alias("n")]
    for x in MEASURES:
        value = F.col(x).cast("decimal(20,0)") if x == "members" else F.col(x).cast("double")
        out += [F.sum(value * F.col("w")).cast(_PARTIALS[x].dataType).alias(x),
                F.sum(F.when(F.col(x).isNotNull(), F.col("w"))).alias(f"{x}_n")]
    return out


def _again() -> list[Column]:
    """The measures of a mart from its partials."""
    return [F.sum("n").cast("long").alias("n"),
            *[F.sum(c).alias(c) for x in MEASURES for c in (x, f"{x}_n")]]


def _mean(x: str) -> Column:
    return F.col(x).cast("double") / F.nullif(F.col(f"{x}_n"), F.lit(0)).cast("double")


def _total(x: str) -> Column:
    return F.coalesce(F.col(x).cast("long"), F.lit(0).cast("long")).alias(x)


class StoredMarts(BucketStore):
    """The stored partials under ``root`` of the silver tables of ``silver``.

    Link tables that ``silver`` does not have give no marts; without those of
    ``WEIGHING`` every title counts once."""

    def __init__(self, silver: BucketStore, root: str):
        super().__init__(silver.spark, root, {"partials": (_PARTIALS, "key"), "names": (_NAMES, "id")})
        self.silver = silver
        self.kinds = [k for k in KINDS if f"links_anime_{k}" in silver.tables]
        self.sources = ["anime", *[f"links_anime_{k}" for k in self.kinds]]
        self.marts_log = self.log("marts")

    # ------------------------------------------------------------------ refreshing
    def state(self) -> dict[str, Any]:
        """{"partials", "names": {bucket: [attempt, rows]}, "made_from": {bucket: {table: attempt}}, "several"}."""
        return self.marts_log.last()[1] or {"partials": {}, "names": {}, "made_from": {}, "several": None}

    def _now(self) -> tuple[dict[str, int | None], dict[str, dict[str, str]], int]:
        """Versions, {bucket: {table: attempt}} and the number of buckets of the silver tables."""
        versions, made_of, buckets = {}, {}, set()
        for name in self.sources:
            version, entry = self.silver._manifest(name, None)
            versions[name] = version or None
            if version:
                buckets.add(entry["buckets"])
            for bucket, (attempt, _) in entry["files"].items():
                made_of.setdefault(bucket, {})[name] = attempt
        if len(buckets) > 1:
            raise ValueError(f"the silver tables differ in their number of buckets: {sorted(buckets)}")
        return versions, made_of, buckets.pop() if buckets else self.silver.buckets

    def _replaced(self, name: str, old: dict, rows: DataFrame, todo: list[str], gone: list[str]) -> dict[str, list]:
        mine = self._write(name, rows) if todo else {}
        return {b: f for b, f in old.items() if b not in todo and b not in gone} | mine

    def refresh(self) -> list[int]:
        """Bring the partials up to the silver tables' current versions; the buckets computed."""
        number, old = self.marts_log.last()
        old = old or self.state()
        versions, now, buckets = self._now()
        changed = [b for b in now if now[b] != old["made_from"].get(b)]
        gone = [b for b in old["made_from"] if b not in now]
        links = {k: self._links(k, versions, buckets, changed) for k in self.kinds}
        names_rows = None
        for kind, df in links.items():
            i, n = S.link_cols(S.LINK_NAMES[kind])
            part = df.select(BUCKET, F.lit(kind).alias("kind"), F.col(i).cast("string").alias("id"), F.col(n).alias("name"))
            names_rows = part if names_rows is None else names_rows.unionByName(part)
        names = {} if names_rows is None else self._replaced("names", old["names"], names_rows.distinct(), changed, gone)
        several = self._several(names)
        mark = several.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("kind", "id", "n_names").cast("decimal(38,0)")).alias("h")).first()
        mark = f"{mark.n}:{mark.h}"
        todo = changed if mark == old["several"] or old["several"] is None else list(now)
        if todo != changed:
            links = {k: self._links(k, versions, buckets, todo) for k in self.kinds}
        if not todo and not gone:
            return []
        partials = self._replaced("partials", old["partials"], self._compute(versions, buckets, todo, links, several), todo, gone)
        entry = {"partials": partials, "names": names, "several": mark, "made_from": now}
        if not self.marts_log.publish(number + 1, entry):
            return self.refresh()  # another one was first: what is left to do now
        return sorted(int(b) for b in todo)

    def _rows(self, name: str, versions: dict, buckets: int, todo: list[str]) -> DataFrame:
        if versions[name] is None:
            rows = self.spark.createDataFrame([], self.silver.tables[name][0])
        else:
            rows = self.silver.read(name, versions[name], [int(b) for b in todo])
        return rows.withColumn(BUCKET, self.silver.bucket_of(name, buckets))

    def _links(self, kind: str, versions: dict, buckets: int, todo: list[str]) -> DataFrame:
        return self._rows(f"links_anime_{kind}", versions, buckets, todo)

    def _several(self, names: dict[str, list]) -> DataFrame:
        """(kind, id, n_names) of the weighing ids that have more than one name."""
        all_names = self._scan("names", names).where(F.col("kind").isin(*WEIGHING) & F.col("id").isNotNull())
        return (all_names.select("kind", "id", "name").distinct().groupBy("kind", "id")
                .agg(F.count(F.lit(1)).alias("n_names")).where("n_names > 1"))

    def _compute(self, versions: dict, buckets: int, todo: list[str], links: dict[str, DataFrame], several: DataFrame) -> DataFrame:
        """Partials of the buckets ``todo``, with ``_bucket``."""
        base = self._rows("anime", versions, buckets, todo).select(BUCKET, "anime_id", "batch_id", "year", "source", *MEASURES)
        counted = None
        for kind in WEIGHING:
            if kind not in links:
                continue
            i, _ = S.link_cols(S.LINK_NAMES[kind])
            more = several.where(F.col("kind") == kind).select(F.col("id").alias("__id"), "n_names")
            per = (links[kind].join(more, F.col(i).cast("string") == F.col("__id"), "left")
                   .select("anime_id", *[(F.coalesce("n_names", F.lit(1)) if k == kind else F.lit(0).cast("long")).alias(f"w_{k}") for k in WEIGHING]))
            counted = per if counted is None else counted.unionByName(per)
        if counted is None:
            base = base.withColumns({f"w_{k}": F.lit(1).cast("long") for k in WEIGHING})
        else:
            weights = counted.groupBy("anime_id").agg(*[F.sum(f"w_{k}").alias(f"w_{k}") for k in WEIGHING])
            base = base.join(weights, "anime_id", "left").withColumns(
                {f"w_{k}": F.greatest(F.coalesce(f"w_{k}", F.lit(0)), F.lit(1)).cast("long") for k in WEIGHING})
        full = F.col("w_licensors") * F.col("w_genres")
        own = F.array(F.struct(F.lit("total").alias("mart"), F.lit(None).cast("string").alias("key")),
                      F.struct(F.lit("source").alias("mart"), F.col("source").alias("key")))
        rows = base.select(BUCKET, "batch_id", "year", *MEASURES, full.alias("w"), F.explode(own).alias("m")).select("*", "m.*").drop("m")
        tagged = None
        for kind, df in links.items():
            i, _ = S.link_cols(S.LINK_NAMES[kind])
            part = df.select("anime_id", F.lit(kind).alias("mart"), F.col(i).cast("string").alias("key"))
            tagged = part if tagged is None else tagged.unionByName(part)
        if tagged is not None:
            # a licensor row stands once per genre row of its title
            w = F.when(F.col("mart") == "licensors", F.col("w_genres")).otherwise(full)
            rows = rows.unionByName(base.join(tagged, "anime_id").select(BUCKET, "batch_id", "year", *MEASURES, w.alias("w"), "mart", "key"))
        return rows.groupBy(BUCKET, "mart", "batch_id", "year", "key").agg(*_sums()).select(*_PARTIALS.fieldNames(), BUCKET)

    # ----------------------------------------------------------------------- marts
    def partials(self, mart: str, year_range: tuple[int, int] | None = None) -> DataFrame:
        """The latest batch's partials of one mart, of the years in ``year_range``."""
        rows = self._scan("partials", self.state()["partials"])
        latest = rows.where("mart = 'total'").agg(F.max("batch_id")).scalar()
        rows = rows.where((F.col("mart") == mart) & (F.col("batch_id") == latest))
        return rows if year_range is None else rows.where(F.col("year").between(*year_range))

    def _named(self, kind: str, year_range: tuple[int, int] | None, by: list[str]) -> DataFrame:
        """Sums by the names of a link kind (and ``by``); null names drop out."""
        _, name = S.link_cols(S.LINK_NAMES[kind])
        sums = self.partials(kind, year_range).groupBy("key", *by).agg(*_again())
        dim = (self._scan("names", self.state()["names"]).where((F.col("kind") == kind) & F.col("name").isNotNull())
               .select(F.col("id").alias("key"), F.col("name").alias(name)).distinct())
        return sums.join(dim, "key").groupBy(name, *by).agg(*_again())

    def kpis(self, year_range: tuple[int, int] | None = None) -> DataFrame:
        sums = self.partials("total", year_range).agg(*_again())
        return sums.select(_mean("score").alias("avg_score"), _total("members").alias("total_members"))

    def _by_source(self, year_range: tuple[int, int] | None) -> DataFrame:
        rows = self.partials("source", year_range).where("key IS NOT NULL")
        return rows.groupBy(F.col("key").alias("source")).agg(*_again())

    def source_analysis(self, year_range: tuple[int, int] | None = None) -> DataFrame:
        return self._by_source(year_range).select("source", _mean("score").alias("score"),
                                                  _mean("popularity").alias("popularity"), F.col("n").alias("anime_count"))

    def source_summary(self, year_range: tuple[int, int] | None = None) -> DataFrame:
        return (self._by_source(year_range)
                .select("source", F.col("n").alias("anime_count"), _mean("members").alias("members"), _mean("score").alias("score"))
                .orderBy(F.desc_nulls_last("members"), F.asc("source")))

    def source_share(self, year_range: tuple[int, int] | None = None) -> DataFrame:
        return share_of_total(self._by_source(year_range).select("source", F.col("n").alias("anime_count")), "anime_count")

    def year_trend(self, year_range: tuple[int, int] | None = None) -> DataFrame:
        sums = self.partials("total", year_range).where("year IS NOT NULL").groupBy("year").agg(*_again())
        return sums.select("year", F.col("n").alias("anime_count"), _total("members"), _mean("score").alias("score"))

    def genre_summary(self, year_range: tuple[int, int] | None = None) -> DataFrame:
        return self._named("genres", year_range, []).select("genre_name", F.col("n").alias("anime_count"), _total("members"),
                                                            _mean("score").alias("score"))

    def genre_top(self, k: int = 15, year_range: tuple[int, int] | None = None) -> DataFrame:
        return top_k(self.genre_summary(year_range), [F.desc_nulls_last("members"), F.asc("genre_name")], k)

    def genre_by_year(self, year_range: tuple[int, int] | None = None) -> DataFrame:
        rows = self._named("genres", year_range, ["year"]).where("year IS NOT NULL")
        return rows.select("year", "genre_name", _total("members"))

    def dim_metrics(self, kind: str, year_range: tuple[int, int] | None = None, min_support: int = S.MIN_SUPPORT) -> DataFrame:
        """Studios, producers, ... and the licensors by their own weight, see ``marts``."""
        _, name = S.link_cols(S.LINK_NAMES[kind])
        return (self._named(kind, year_range, [])
                .select(name, F.col("n").alias("anime_count"), _mean("score").alias("score"), _mean("members").alias("members"))
                .where(F.col("anime_count") >= min_support))
