"""What is new in a stream of pages, by keyed state.

The state of a source is the digest of its last content and the ordinal of that page.
Pages that come again, in replayed files or unchanged, are told apart from inserts and
updates before they are parsed, embedded or written.
"""

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from pagewell import schemas

#: The store that keyed state of this kind needs.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

CHANGED = T.StructType([*schemas.PAGE.fields, T.StructField("change", T.StringType())])


class _Changes(StatefulProcessor):
    """One row per source and micro-batch: its last page there, and what it changes."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._last = handle.getValueState("last", "ordinal long, digest string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        # Of equal ordinals the greatest digest, whatever the order of arrival.
        page = max(rows, key=lambda r: (r["ordinal"], r["digest"]))
        known = self._last.get() if self._last.exists() else None
        if known is None:
            change = "insert"
        elif known[1] == page["digest"]:
            change = "unchanged"
        elif (page["ordinal"], page["digest"]) < (known[0], known[1]):
            change = "late"
        else:
            change = "update"
        if change in ("insert", "update") or (change == "unchanged" and page["ordinal"] > known[0]):
            self._last.update((page["ordinal"], page["digest"]))
        yield Row(ordinal=page["ordinal"], source=key[0], content=page["content"], change=change)

    def close(self) -> None:
        pass


def page_changes(pages: DataFrame) -> DataFrame:
    """`ordinal, source, content, change` of a stream of pages, one row per source and
    micro-batch, for its page with the greatest ordinal there.

    `change` is `insert` for a source never seen, `unchanged` for the content seen last,
    `late` for other content of an earlier version, else `update`. The ordinal is the version;
    of equal ones with other content the greater digest is the later one, so replays end alike. Null sources are left
    out, a null ordinal counts as -1 and a null content is a content. Pages of one source are
    read one after the other and one of them is kept. The session needs
    STATE_STORE as `spark.sql.streaming.stateStore.providerClass`.
    """
    digest = F.coalesce(F.sha2("content", 256), F.lit(""))
    rows = pages.where(F.col("source").isNotNull()).select(
        F.coalesce(F.col("ordinal").cast("long"), F.lit(-1)).alias("ordinal"), "source", "content",
        digest.alias("digest"))
    return rows.groupBy("source").transformWithState(
        _Changes(), CHANGED, outputMode="Append", timeMode="None")
