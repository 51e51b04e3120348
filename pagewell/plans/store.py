"""Collections in a folder of parquet files.

`points/<md5 of the name>/batch_id=…/` holds the points of each write, `catalog/` one
row per creation, write, compaction and deletion. A write becomes visible with its
catalog row, so a job that dies half-way leaves nothing visible behind, and its
repetition replaces what it left. Reading lists the files of the visible writes of one
collection and no others. One writer at a time.
"""

import re
from collections.abc import Sequence
from dataclasses import dataclass
from hashlib import md5

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pagewell import schemas
from pagewell.operators import codes as K
from pagewell.operators import collections as C
from pagewell.operators import search as S
from pagewell.operators.embed import Embedder, check_vectors, vector_size
from pagewell.operators.newest import newest_of_batches, newest_with_copies
from pagewell.operators.points import points_from_texts
from pagewell.plans.registry import get_embedder

#: Compaction writes a file for so many bytes of the batches that it reads.
FILE_BYTES = 128 << 20


@dataclass
class _State:
    """What the catalog says about one collection."""

    vector_size: int
    distance: str
    batches: list[int]


def _bad_vectors(marked: DataFrame) -> DataFrame:
    """Points marked by `check_vectors`, in the shape of rejects."""
    payload = dict(marked.dtypes)["payload"]
    told = {c: F.col("payload")[c] if re.search(rf"[<,]{c}:", payload) else F.lit(None).cast("string")
            for c in ("source", "source_type")}
    return marked.where(F.col("reason").isNotNull()).select(
        "ordinal", *(v.alias(c) for c, v in told.items()), "reason",
        F.col("point_id").alias("detail"))


class CollectionStore:
    def __init__(self, spark: SparkSession, path: str, embedder: Embedder | str = "hashed"):
        self.spark = spark
        self.points_path = f"{path}/points"
        self.codes_path = f"{path}/codes"
        self.catalog_path = f"{path}/catalog"
        self.rejects_path = f"{path}/rejects"
        self.embedder = get_embedder(embedder) if isinstance(embedder, str) else embedder

    # -- reading -------------------------------------------------------------

    def _path(self, path: str):
        """A path and its file system, as Spark sees them."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder, folder.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def catalog(self) -> DataFrame:
        folder, files = self._path(self.catalog_path)
        if files.exists(folder):
            return self.spark.read.schema(schemas.CATALOG).parquet(self.catalog_path)
        return self.spark.createDataFrame([], schemas.CATALOG)

    def _folder(self, name: str) -> str:
        return f"{self.points_path}/{md5(name.encode()).hexdigest()}"

    def _state(self, name: str) -> _State | None:
        """From the catalog rows of one name, of which there is one per write, in one job."""
        told = self.catalog().where(F.col("name") == name).select(
            "batch_id", "deleted", "action", "vector_size", "distance").collect()
        dropped = max((r["batch_id"] for r in told if r["deleted"]), default=-1)
        rows = sorted((r for r in told if r["batch_id"] > dropped), key=lambda r: r["batch_id"])
        if not rows:
            return None
        base = max((r["batch_id"] for r in rows if r["action"] == "compact"), default=-1)
        batches = {r["batch_id"] for r in rows if r["action"] in ("upsert", "compact") and r["batch_id"] >= base}
        return _State(rows[0]["vector_size"], rows[0]["distance"], sorted(batches))

    def _existing(self, name: str) -> _State:
        state = self._state(name)
        if state is None:
            raise ValueError(f"Unknown collection: {name}")
        return state

    def _log(self, name: str, batches: list[int]) -> DataFrame:
        if not batches:
            return self.spark.createDataFrame([], schemas.POINT_LOG)
        folder = self._folder(name)
        return self.spark.read.schema(schemas.POINT_LOG).option("basePath", folder).parquet(
            *(f"{folder}/batch_id={batch}" for batch in batches))

    def _keys(self, log: DataFrame, batches: list[int]) -> DataFrame:
        """`point_id, batch_id` of the live rows; the points of one batch are distinct."""
        keys = log.select("point_id", "batch_id")
        return keys if len(batches) < 2 else keys.groupBy("point_id").agg(
            F.max("batch_id").alias("batch_id"))

    def points(self, name: str) -> DataFrame:
        """Live points of a collection. After compaction this is a plain scan; before it, ids
        written several times are counted, see `newest_of_batches`."""
        batches = self._existing(name).batches
        log = self._log(name, batches)
        return log if len(batches) < 2 else newest_of_batches(log)

    def list(self) -> DataFrame:
        return C.list_collections(self.catalog())

    def info(self, name: str) -> DataFrame:
        state = self._existing(name)
        keys = self._keys(self._log(name, state.batches), state.batches)
        return keys.agg(F.count(F.lit(1)).alias("points_count")).select(
            F.lit(name).alias("name"), F.lit(state.vector_size).alias("vector_size"),
            F.lit(state.distance).alias("distance"), "points_count")

    def count(self, name: str) -> int:
        batches = self._existing(name).batches
        return self._keys(self._log(name, batches), batches).count()

    def scroll(self, name: str, limit: int = C.DEFAULT_LIMIT, offset: str | None = None):
        batches = self._existing(name).batches
        log = self._log(name, batches)
        return C.scroll_page(log, limit, offset, self._keys(log, batches))

    def scroll_all(self, name: str, limit: int = C.DEFAULT_LIMIT) -> DataFrame:
        batches = self._existing(name).batches
        log = self._log(name, batches)
        return C.scroll_all(log, limit, self._keys(log, batches))

    def search_vector(self, name: str, query: Sequence[float], limit: int = C.DEFAULT_LIMIT):
        """Hits with payload, by rank. Only ids and vectors are read to find them; the
        payloads are then joined by id."""
        points = self.points(name)
        hits = S.search_vector(points.select("point_id", "vector"), query, limit)
        return hits.join(points.select("point_id", "payload"), "point_id").select(
            "point_id", "payload", "score", "rank").orderBy("rank")

    def search(self, name: str, query: str, limit: int = C.DEFAULT_LIMIT) -> DataFrame:
        probe = self.spark.range(1).select(F.lit(query).alias("query"))
        vector = S.embed_queries(probe, self.embedder).first()["query_vector"]
        return self.search_vector(name, vector, limit)

    def search_batch(self, name: str, queries: DataFrame, k: int = C.DEFAULT_LIMIT) -> DataFrame:
        return S.search_batch(self.points(name), queries, k, self.embedder)

    def _code_folder(self, name: str) -> str:
        return f"{self.codes_path}/{md5(name.encode()).hexdigest()}"

    def codes(self, name: str) -> DataFrame:
        """`point_id, code, step, error` of the live points, see `operators.codes`."""
        batches = self._existing(name).batches
        if not batches:
            return self.spark.createDataFrame([], schemas.CODE_LOG)
        folder = self._code_folder(name)
        log = self.spark.read.schema(schemas.CODE_LOG).option("basePath", folder).parquet(
            *(f"{folder}/batch_id={batch}" for batch in batches))
        return log if len(batches) < 2 else newest_of_batches(log)

    def search_nearby(self, name: str, queries: DataFrame, k: int = C.DEFAULT_LIMIT) -> DataFrame:
        """`query_id, rank, point_id, score` of k hits for each of `query_id, query_vector`.

        Codes, which each write adds beside its points, are scanned in place of vectors;
        those of candidates alone are fetched. Nothing is lost by that, as the errors of
        the codes are known: the hits are the k best.
        """
        points = self.points(name).select("point_id", "vector")
        return K.search_codes(self.codes(name), points, queries, k)

    # -- writing -------------------------------------------------------------

    def _record(self, name, batch_id, action, state=None, deleted=False, sent=None, origin=None):
        row = (name, state and state.vector_size, state and state.distance, batch_id,
               deleted, action, sent, origin)
        self.spark.createDataFrame([row], schemas.CATALOG).coalesce(1).write.mode(
            "append").parquet(self.catalog_path)

    def _next_batch(self) -> int:
        last = self.catalog().agg(F.max("batch_id")).first()[0]
        return 0 if last is None else last + 1

    def create(self, name: str, size: int, distance: str = C.COSINE) -> None:
        """Create an empty collection; an existing one is left as it is."""
        if not name:
            raise ValueError("A collection needs a name")
        if distance.lower() != C.COSINE:
            raise ValueError(f"Unsupported distance: {distance}")
        if self._state(name) is None:
            self._record(name, self._next_batch(), "create", _State(size, C.COSINE, []))

    def ensure(self, name: str) -> None:
        """Create a missing collection with the embedder's vector size."""
        if self._state(name) is None:
            size = vector_size(self.spark, self.embedder).first()["vector_size"]
            self.create(name, size)

    def delete(self, name: str) -> bool:
        self._record(name, self._next_batch(), "delete", deleted=True)
        return True

    def _write(self, name: str, batch_id: int, points: DataFrame) -> None:
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.POINT.fields]
        (points.select(*columns).write.mode("overwrite")
         .option("parquet.bloom.filter.enabled#point_id", "true")
         .parquet(f"{self._folder(name)}/batch_id={batch_id}"))
        written = self._log(name, [batch_id]).select("point_id", "vector")
        K.add_codes(written).drop("vector").write.mode("overwrite").parquet(
            f"{self._code_folder(name)}/batch_id={batch_id}")

    def upsert(
        self, name: str, points: DataFrame, distinct: bool = False, origin: str | None = None,
    ) -> int:
        """Write points, the last one of each id; returns how many were sent.

        `distinct` says that no id comes twice. A write with an `origin` that is
        already recorded for this collection has been done and is not repeated.
        Nothing sent means that no collection is made. Vectors that do not fit the
        collection (a new one has the embedder's size) are not written; their points are
        added to the table `rejects` of the store.
        """
        if not name:
            raise ValueError("A collection needs a name")
        if origin is not None:
            done = self.catalog().where(
                (F.col("name") == name) & (F.col("origin") == origin)).select("sent").first()
            if done is not None:
                return done["sent"]
        if not distinct:
            repeated = points.withColumnRenamed("copies", "_each")
            points = newest_with_copies(
                repeated, ["point_id"], ["ordinal", "part"]).drop("_each")
        state = self._state(name)
        if state is None:
            size = vector_size(self.spark, self.embedder).first()["vector_size"]
            state = _State(size, C.COSINE, [])
        seen = Observation()
        batch_id = self._next_batch()
        marked = check_vectors(points, state.vector_size)
        fits = F.col("reason").isNull()
        self._write(name, batch_id, marked.observe(
            seen, F.coalesce(F.sum(F.when(fits, F.col("copies"))), F.lit(0)).alias("sent"),
            F.count(F.when(~fits, 1)).alias("bad")).where(fits).drop("reason"))
        if seen.get["bad"]:
            # Under the number of the batch, so that a repeated write replaces them.
            _bad_vectors(marked).withColumn("collection", F.lit(name)).write.mode("overwrite").parquet(
                f"{self.rejects_path}/batch_id={batch_id}")
        sent = seen.get["sent"]
        if not sent:
            return 0
        self._record(name, batch_id, "upsert", state, sent=sent, origin=origin)
        return sent

    def add_documents(self, name: str, texts: DataFrame, origin: str | None = None) -> int:
        """Embed and write `ordinal, text` and maybe `metadata`."""
        points = points_from_texts(texts, self.embedder, distinct=True)
        return self.upsert(name, points, distinct=True, origin=origin)

    def checked(self, name: str, points: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Points that fit the collection, and `bad_vector` rejects."""
        marked = check_vectors(points, self._existing(name).vector_size)
        return marked.where(F.col("reason").isNull()).drop("reason"), _bad_vectors(marked)

    def compact(self, name: str) -> None:
        """Rewrite the live points as one batch in id order; older batches are left unread."""
        state = self._existing(name)
        if len(state.batches) < 2:
            return
        batch_id = self._next_batch()
        live = self.points(name).drop("batch_id")
        size = 0
        for batch in state.batches:
            folder, files = self._path(f"{self._folder(name)}/batch_id={batch}")
            size += files.getContentSummary(folder).getLength()
        self._write(name, batch_id, live.repartitionByRange(-(-size // FILE_BYTES) or 1, "point_id")
                    .sortWithinPartitions("point_id"))
        self._record(name, batch_id, "compact", state)
