"""An index of three-letter pieces, so that a keyword search opens few files."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidscope.operators.filters import SearchCriteria, search_tenders
from bidscope.schemas import INT, LONG, TEXT
from bidscope.session import spread, staged
from bidscope.sources.store import _Versions

#: The fields that criteria search inside, by the name of the criterion.
FIELDS = {"keyword": "tender_object", "buyer": "public_buyer"}
GRAM = 3
#: Rows of postings and of holders in a bucket, about.
BUCKET_POSTINGS = 1 << 22
#: Pieces looked up for one criterion. Fewer pieces find more candidates, never fewer results.
RAREST = 3

_POSTINGS = T.StructType(
    [
        *[T.StructField(name, TEXT) for name in ("field", "gram")],
        T.StructField("text", LONG),
        *[T.StructField(name, INT) for name in ("version", "bucket")],
    ]
)
_HOLDERS = T.StructType(
    [
        T.StructField("field", TEXT),
        *[T.StructField(name, LONG) for name in ("text", "id")],
        *[T.StructField(name, INT) for name in ("version", "bucket")],
    ]
)
_GRAMS = T.StructType(
    [
        *[T.StructField(name, TEXT) for name in ("field", "gram")],
        T.StructField("n", LONG),
        T.StructField("version", INT),
    ]
)


def grams(lower: Column) -> Column:
    """The distinct pieces of ``GRAM`` code points of a lower-cased text of as many at least.

    Pass a column, not an expression: Spark computes what a lambda names once for each piece.
    """
    starts = F.sequence(F.lit(1), F.length(lower) - GRAM + 1)
    return F.array_distinct(F.transform(starts, lambda at: F.substring(lower, at, GRAM)))


class KeywordIndex(_Versions):
    """Postings (field, piece, text) in folders by a hash of field and piece, sorted inside, and
    holders (field, text, id) in folders by a hash of the text.

    A text is told by a hash of its lower-cased form, and a text that many tenders share is taken
    apart once. ``build`` indexes all tenders anew, ``add`` those that are new or changed: postings
    and holders only name candidates, and every candidate is tested against the tender as it is now,
    so those of an earlier text, or of another one with the same hash, do no harm. Beside the
    postings lie the counts of all pieces. A search looks up its own pieces there, takes the rarest,
    and opens their folders alone, and the folders of the texts it finds.
    """

    def build(self, tenders: DataFrame) -> int:
        return self._add(tenders, full=True)

    def add(self, tenders: DataFrame) -> int:
        return self._add(tenders, full=self.version() == 0)

    def _add(self, tenders: DataFrame, full: bool) -> int:
        version = self.version() + 1
        lowered = [F.struct(F.lit(field).alias("field"), F.lower(field).alias("lower")) for field in FIELDS.values()]
        said = tenders.select("id", F.explode(F.array(*lowered)).alias("said")).select("id", "said.*")
        said = staged(said.filter(F.length("lower") >= GRAM).withColumn("text", F.xxhash64("lower")), "keyword-texts")
        # Few small rows become many: dealt out, or a few tasks would cut all texts.
        distinct = spread(said.select("field", "lower", "text").distinct())
        cut = staged(distinct.select("field", "text", grams(F.col("lower")).alias("grams")), "keyword-pieces")
        found = cut.select("field", F.explode("grams").alias("gram"), "text")
        self._write("grams", version, found.groupBy("field", "gram").agg(F.count("*").alias("n")).sort("field", "gram"))
        buckets = self._state().buckets
        if full:
            total = (cut.agg(F.sum(F.size("grams"))).first()[0] or 0) + said.count()
            buckets = -(-total // BUCKET_POSTINGS) or 1
        # Ranges of equal size: a piece of very many texts fills several files of its folder.
        for name, rows, key in (("postings", found, "gram"), ("holders", said.select("field", "text", "id"), "text")):
            order = ["bucket", "field", *rows.columns[1:]]
            rows = rows.withColumn("bucket", _bucket(buckets, key)).repartitionByRange(*order).sortWithinPartitions(*order)
            self._write(name, version, rows, "bucket")
        self._commit(version=version, full=full, buckets=buckets)
        return version

    def _write(self, name: str, version: int, rows: DataFrame, *folders: str) -> None:
        rows.write.mode("overwrite").partitionBy(*folders).parquet(f"{self.root}/{name}/version={version}")

    def _state(self):
        """The last build, its buckets, and the last version; all 0 before the first."""
        full = F.when(F.col("full"), F.col("version"))
        state = self._commits().agg(
            F.coalesce(F.max(full), F.lit(0)).alias("full"),
            F.coalesce(F.max_by("buckets", full), F.lit(1)).alias("buckets"),
            F.coalesce(F.max("version"), F.lit(0)).alias("version"),
        )
        return state.first()

    def _read(self, name: str, schema: T.StructType, state) -> DataFrame:
        if not state.version:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        return rows.filter(F.col("version").between(state.full, state.version))

    def candidates(self, field: str, text: str) -> DataFrame | None:
        """Ids whose field may hold the text; None if it is too short to say.

        At most one row for each of the text's own pieces reaches the driver.
        """
        lower = text.lower()
        wanted = sorted({lower[at : at + GRAM] for at in range(len(lower) - GRAM + 1)})
        if not wanted:
            return None
        state = self._state()
        holders = self._read("holders", _HOLDERS, state)
        known = self._read("grams", _GRAMS, state).filter((F.col("field") == field) & F.col("gram").isin(wanted))
        known = known.groupBy("gram").agg(F.sum("n").alias("n"), F.first(_bucket(state.buckets, "gram", F.lit(field))).alias("bucket"))
        known = sorted(known.collect(), key=lambda row: (row.n, row.gram))
        postings = self._read("postings", _POSTINGS, state)
        if len(known) < len(wanted):  # a piece that no text has
            return holders.select("id").filter(F.lit(False))
        rarest = known[:RAREST]
        chosen = F.col("gram").isin([row.gram for row in rarest]) & (F.col("field") == field)
        chosen &= F.col("bucket").isin(sorted({row.bucket for row in rarest}))
        # A text indexed again has the same piece in several versions.
        found = postings.filter(chosen).groupBy("text").agg(F.count_distinct("gram").alias("n"))
        found = found.filter(F.col("n") == len(rarest)).select("text")
        touched = found.select(_bucket(state.buckets, "text", F.lit(field)).alias("bucket")).distinct()
        touched = [row.bucket for row in touched.collect()]  # at most all
        holders = holders.filter((F.col("field") == field) & F.col("bucket").isin(touched))
        return found.join(holders.select("text", "id"), "text").select("id").distinct()

    def search(self, tenders: DataFrame, criteria: SearchCriteria) -> DataFrame:
        """``search_tenders`` through the index, which must hold all of ``tenders``.

        Keyword and buyer are looked up; one of under ``GRAM`` characters is only tested.
        """
        for name, field in FIELDS.items():
            text = getattr(criteria, name)
            found = self.candidates(field, text) if text else None
            if found is not None:
                tenders = tenders.join(found, "id", "left_semi")
        return search_tenders(tenders, criteria)


def _bucket(buckets: int, key: str, field: Column | None = None) -> Column:
    hashed = F.xxhash64(F.col("field") if field is None else field, key)
    return F.pmod(hashed, F.lit(buckets)).cast("int")
