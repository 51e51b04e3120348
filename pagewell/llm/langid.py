"""Language identification with n-gram filters that hold languages as bits.

Training finds, for every language, the character n-grams that occur in the largest share
of its texts. A Bloom filter of words instead of bits takes them all: the word at each of
an n-gram's slots has one bit per language, so the AND of the slots tells at once all
languages that hold the n-gram. A text's n-grams are looked up together and counted per
language. A filter filled to a share f answers yes to a strange n-gram with f^k, so a
count c of n becomes (c - n f^k) / (1 - f^k), and the largest corrected count decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewell.llm.shared import give_back, materialise, table

#: Length of n-grams; n-grams per language; slots per n-gram; slots for each n-gram held.
N, GRAMS, SLOTS, SPREAD = 4, 8_000, 4, 12
#: Different texts per language that are learned from (those with the least hash).
LEARNED = 4_000
#: N-grams of texts that a task holds before it counts them.
HELD = 2_000_000
#: An n-gram is held only if it is in so large a share of the language's texts.
LEAST_SHARE = 0.002
FOLDS, UNKNOWN = 5, "und"
#: A text is in no learned language if its score is below this part of a low quantile of
#: the scores that labelled texts of that language have, which were not learned from.
BOUND_PART, BOUND_QUANTILE = 0.5, 0.01


def _hashes(text: str) -> np.ndarray:
    """Hashes of the n-grams of a text in lower case, with its blanks made one each."""
    points = np.frombuffer((" " + " ".join(text.lower().split()) + " ").encode("utf-32-le", "replace"), np.uint32)
    points = points.astype(np.uint64)
    if len(points) < N:
        return np.zeros(0, np.uint64)
    h = np.zeros(len(points) - N + 1, np.uint64)
    for k in range(N):
        h = (h ^ points[k:len(points) - N + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def _has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def _slots(h: np.ndarray, size: int) -> list[np.ndarray]:
    a, b = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return [((a + np.uint64(k) * b) % np.uint64(size)).astype(np.int64) for k in range(SLOTS)]


class Filters:
    """The trained filters: bounded by the number of languages times `GRAMS`."""

    def __init__(self, languages: list[str], grams: list[np.ndarray]):
        self.languages = languages
        self.size = max(64, SPREAD * max((len(g) for g in grams), default=0))
        words = (len(languages) + 63) // 64
        self.masks = np.zeros((max(1, words), self.size), np.uint64)
        for k, held in enumerate(grams):
            for at in _slots(held, self.size):
                self.masks[k >> 6, at] |= np.uint64(1 << (k & 63))
        filled = np.array([np.count_nonzero(self.masks[k >> 6] >> np.uint64(k & 63) & np.uint64(1))
                           for k in range(len(languages))])
        self.false = (filled / self.size) ** SLOTS

    def shares(self, text: str) -> np.ndarray:
        """For each language the corrected share of the text's n-grams that it holds."""
        h = _hashes(text)
        counts = np.zeros(len(self.languages))
        for start in range(0, len(h), 1 << 18):
            slots = _slots(h[start:start + (1 << 18)], self.size)
            for word in range(len(self.masks)):
                found = self.masks[word][slots[0]]
                for at in slots[1:]:
                    found = found & self.masks[word][at]
                for k in range(word * 64, min(len(self.languages), word * 64 + 64)):
                    counts[k] += np.count_nonzero(found & np.uint64(1 << (k & 63)))
        share = counts / max(1, len(h))
        return np.clip((share - self.false) / np.maximum(1e-9, 1 - self.false), 0, 1)

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and its share; ties go to the first by code point."""
        if not self.languages or not text or not _has_letter(text):
            return UNKNOWN, 0.0
        shares = self.shares(text)
        best = int(np.argmax(shares))
        return self.languages[best], float(shares[best])


def _least(rows: DataFrame, keys: list, count: int) -> DataFrame:
    """Of each `lang` the `count` rows with the least keys, and those that tie with the last.

    The bounds come from counts per key, one key after another, so no language's rows meet
    in one task: what is gathered is a count per value of a key.
    """
    taken, tied = F.lit(False), F.lit(True)
    left = F.lit(count).cast("long")
    for k, key in enumerate(keys):
        sizes = rows.where(tied).groupBy("lang", key.cast("long").alias("key")).agg(
            F.count(F.lit(1)).alias("n"), F.max(left).alias("left"))
        each = sizes.groupBy("lang").agg(F.max("left").alias("left"),
                                         F.sort_array(F.collect_list(F.struct("key", "n"))).alias("sizes"))
        # Goes up the keys while rows are wanted; `before`: those wanted from the last key on.
        end = F.expr("""aggregate(sizes, named_struct('last', cast(null as bigint), 'before', left, 'left', left),
            (a, s) -> if(a.left > 0, named_struct('last', s.key, 'before', a.left, 'left', a.left - s.n), a))""")
        bound = materialise(each.select(F.col("lang").alias(f"_lang{k}"), end.alias("_end")).select(
            f"_lang{k}", F.col("_end.last").alias(f"_last{k}"), F.col("_end.before").alias(f"_left{k}")), "bounds")
        rows = rows.join(bound, F.col("lang") == F.col(f"_lang{k}"))
        taken = taken | (tied & (key < F.col(f"_last{k}")))
        tied = tied & (key == F.col(f"_last{k}"))
        left = F.col(f"_left{k}")
    return rows.where(taken | tied)


def _bits(column: str, shift: int):
    """Sixteen bits of a long; the leading ones keep their sign, so the order is that of the longs."""
    part = F.shiftright(column, shift)
    return part if shift == 48 else part.bitwiseAND(F.lit(0xFFFF))


def train(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Filters:
    """Filters from the rows that have a text and a language.

    Per language `LEARNED` different texts are learned from (all, where there are fewer),
    those with the least hash, so the same table trains the same filters and a text that is
    repeated often counts once. Texts whose hashes agree in 32 bits with the last are taken
    too. The driver receives the chosen n-grams only, about `GRAMS` per language. No
    labelled row gives filters without languages.
    """
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(text).alias("_h"))
    hashes = materialise(rows.select("lang", "_h").distinct(), "hashes")
    learned = materialise(_least(hashes, [_bits("_h", 48), _bits("_h", 32)], LEARNED).select(
        F.col("lang").alias("_lang"), F.col("_h").alias("_hash")), "learned")
    chosen = (rows.join(learned, (F.col("lang") == F.col("_lang")) & (F.col("_h") == F.col("_hash")))
              .groupBy("lang", "_h").agg(F.first("text").alias("text")).select("lang", "text"))

    def grams(batches):
        def counted(seen):
            for name, all_ in seen.items():
                gram, n = np.unique(np.concatenate(all_), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * (len(gram) + 1)), pa.array(np.r_[gram.view(np.int64), 0], mask=np.arange(len(gram) + 1) == len(gram)),
                     pa.array(np.r_[n, len(all_)].astype(np.int64))], names=["lang", "gram", "n"])

        seen, held = {}, 0
        for batch in batches:
            for name, text in zip(batch.column(0), batch.column(1)):
                found = np.unique(_hashes(text.as_py()))
                seen.setdefault(name.as_py(), []).append(found)
                held += len(found)
                if held >= HELD:
                    yield from counted(seen)
                    seen, held = {}, 0
        yield from counted(seen)

    # The row without an n-gram has the number of texts.
    counted = materialise(chosen.mapInArrow(grams, "lang string, gram long, n long")
                          .groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    texts = counted.where("gram is null").select(F.col("lang").alias("_lang"), F.col("n").alias("_all"))
    often = counted.where("gram is not null").join(texts, F.col("lang") == F.col("_lang")).where(
        F.col("n") >= F.greatest(F.lit(1), F.col("_all") * LEAST_SHARE)).select("lang", "gram", "n")
    held = _least(often, [-F.col("n"), _bits("gram", 48)], GRAMS).select("lang", "gram", "n").toPandas()
    held = held.sort_values(["lang", "n", "gram"], ascending=[True, False, True])
    languages = sorted(r["lang"] for r in texts.select(F.col("_lang").alias("lang")).collect())
    by_language = {name: np.sort(g["gram"].to_numpy(np.int64)[:GRAMS]) for name, g in held.groupby("lang")}
    languages = [name for name in languages if name in by_language]
    return Filters(languages, [by_language[name].view(np.uint64) for name in languages])


def predict(docs: DataFrame, filters: Filters, text: str = "text") -> DataFrame:
    """The rows of `docs` with `lang_pred` and `score`; columns of these names are replaced.

    Null texts and texts without a letter are `und` with score 0. Whole texts are read.
    """
    model = docs.sparkSession.sparkContext.broadcast(filters)

    @F.arrow_udf("lang_pred string, score double")
    def decide(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            told = [model.value.predict(t.as_py()) for t in texts]
            del texts
            yield pa.StructArray.from_arrays(
                [pa.array([t[0] for t in told], pa.string()), pa.array([t[1] for t in told], pa.float64())],
                names=["lang_pred", "score"])
        give_back()

    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")]
    found = docs.select(*kept, decide(F.col(text).cast("string")).alias("_pw_lang"))
    return found.select(*kept, "_pw_lang.lang_pred", "_pw_lang.score")


def bounds(filters: Filters, labelled: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, float]:
    """The least score of a text of each language, from labelled texts not learned from.

    It is `BOUND_PART` of the `BOUND_QUANTILE` of the scores of those that are told right, so
    a language whose n-grams the filters hold less well asks for less. A language without
    such a text has the bound 0: nothing shows what its texts score, so none is rejected. The
    driver receives a row per language.
    """
    rows = labelled.where(F.col(lang).isNotNull()).select(F.col(lang).alias("_lang"), F.col(text).alias("text"))
    right = predict(rows, filters).where(F.col("_lang") == F.col("lang_pred"))
    low = right.groupBy("lang_pred").agg(F.percentile_approx("score", BOUND_QUANTILE, 10_000).alias("low"))
    return dict.fromkeys(filters.languages, 0.0) | {r["lang_pred"]: BOUND_PART * r["low"] for r in low.collect()}


def known(told: DataFrame, least: dict[str, float]) -> DataFrame:
    """The predicted rows that reach the bound of their language; `und` reaches none."""
    bound = F.create_map(*(F.lit(x) for pair in least.items() for x in pair))
    return told.where(F.col("score") >= bound[F.col("lang_pred")])


def held_out(key: str = "doc_id"):
    return F.crc32(F.col(key).cast("string").cast("binary")) % FOLDS == 0


def op5_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    filters = train(docs.where(~held_out()))
    return predict(docs.select("doc_id", held_out().alias("held_out"), "text"), filters).select(
        "doc_id", "held_out", "lang_pred", "score")


QUERIES = {"op5_language": op5_language}
