"""Token ids of texts, many at a time, inside tasks.

A tokenizer whose pieces end before each single blank gives a text the ids of its
blank-separated parts one after another, so each distinct part is encoded once per chunk
of texts and looked up from then on. So do a byte-level BPE and a sentencepiece model
without pieces that go on after a blank or line end. Others encode whole texts.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of texts that are encoded together; parts remembered between chunks.
CHUNK_BYTES, KNOWN_PARTS = 1_000_000, 400_000
#: New parts are given to the library in lines of so many.
LINE = 400
#: Characters that the library encodes at once; what it gives takes some hundred bytes a token.
AT_ONCE = 200_000
_BEFORE_BLANK = re.compile(r"(?<=\S)(?= \S)")
#: Texts whose words are not told apart by single blanks and line ends alone.
_ODD = ("\\n\\x00|[ \\n][ \\n]|^\\n|[ \\n]$|^$|[\\t\\x0b\\x0c\\r\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}"
        "\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]")
_AFTER_SIGN = r"(?:[^\p{L}\p{N}]|^)[.,](?:[ \n]|$)"
_MARK = "▁"  # a blank in a sentencepiece vocabulary
_FIRST, _GLUED = "\n\n", "\n\x00"  # a part without a blank before it; no part begins so by itself


class _Parts(dict):
    """The number of each part; new ones are noted."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, part: str) -> int:
        number = self[part] = len(self)
        self.new.append(part)
        return number


def _spelled(part: str) -> str:
    if part.startswith((_FIRST, _GLUED)):
        return part[2:]
    return part if part.startswith("\n") else " " + part


def _parts_of_odd(text: str) -> list[str]:
    """A text as parts that end before single blanks; `_spelled` parts joined are the text again."""
    first, *others = _BEFORE_BLANK.split(text)
    return [_FIRST + first, *(o[1:] for o in others)]


def _parts_of_plain(texts: pa.Array, signs: bool) -> pa.ListArray:
    """Parts of texts that are not odd: words, and maybe a stop or comma after a letter or
    digit is a part of its own."""
    spaced = pc.replace_substring(texts, "\n", " \n")
    if not signs:
        return pc.split_pattern(pc.binary_join_element_wise(_FIRST, spaced, ""), " ")
    glued = pc.replace_substring(pc.replace_substring(spaced, ". ", f" {_GLUED}. "), ", ", f" {_GLUED}, ")
    told = pc.if_else(pc.match_substring_regex(texts, _AFTER_SIGN), spaced, glued)
    return pc.split_pattern(pc.binary_join_element_wise(_FIRST, told, ""), " ")


class Encoder:
    """Ids as the tokenizer's library gives them, without begin, end or other added tokens.

    as_text: the strings of special tokens are ordinary text; known_parts: so many parts are
    remembered, some 0.3 KB each.
    """

    def __init__(self, path: str, as_text: bool = False, known_parts: int = KNOWN_PARTS):
        self.known_parts = known_parts
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.by_parts, self.added, self.odd = False, [], _ODD
        if path.endswith(".model"):
            import sentencepiece

            self.library = sentencepiece.SentencePieceProcessor(model_file=path)
            self.vocabulary = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
            self.added, self.odd = [_MARK], _ODD + "|^ "
            self.by_parts = (
                not any(_MARK in v.lstrip(_MARK) or "\n" in v for v in self.vocabulary)
                and "".join(self.library.encode(" a  b\n c ", out_type=str)) == f"{_MARK}{_MARK}a{_MARK}{_MARK}b<0x0A>{_MARK}c{_MARK}")
        else:
            from tokenizers import Tokenizer

            with open(path, encoding="utf-8") as file:
                told = json.load(file)
            self.library = Tokenizer.from_file(path)
            self.library.no_truncation()
            self.library.no_padding()
            size = self.library.get_vocab_size()
            self.vocabulary = [self.library.id_to_token(i) or "" for i in range(size)]
            self.library.encode_special_tokens = as_text
            self.added = [a["content"] for a in told.get("added_tokens") or () if not (as_text and a["special"])]
            before = told.get("pre_tokenizer") or {}
            self.by_parts = (
                told["model"].get("type", "BPE") == "BPE" and not told["model"].get("dropout")
                and not told.get("normalizer") and before.get("type") == "ByteLevel"
                and not before.get("add_prefix_space") and before.get("use_regex", True))
        #: bytes that a token stands for
        self.widths = np.array([len(v) for v in self.vocabulary], np.int64)
        self._forget()

    def _forget(self) -> None:
        self.parts = _Parts()
        self.flat, self.starts = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def forget(self) -> None:
        """Remembers no parts any more; for the end of a task, as the worker outlives it."""
        self._forget()

    def _whole(self, texts: Sequence[str]) -> list:
        if not hasattr(self.library, "encode_batch_fast"):
            return self.library.encode(list(texts), num_threads=1)
        return [e.ids for e in self.library.encode_batch_fast(list(texts), add_special_tokens=False)]

    def _flat(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of whole texts one after another, and how many each has."""
        flat, sizes, begin = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)], 0
        while begin < len(texts):
            end, held = begin, 0
            while end < len(texts) and (end == begin or held + len(texts[end]) <= AT_ONCE):
                held += len(texts[end])
                end += 1
            ids = self._whole(texts[begin:end])
            sizes.append(np.fromiter(map(len, ids), np.int64, len(ids)))
            flat.append(np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes[-1].sum())))
            begin = end
        return np.concatenate(flat), np.concatenate(sizes)

    def _learn(self) -> None:
        """Encodes the new parts: plain words in long lines, whose ids are dealt to the words
        by the bytes they stand for; the others one by one, as are all of a sentencepiece
        model, which puts the blank before each itself."""
        new = self.parts.new
        if self.added == [_MARK]:
            ids = self._whole([p[2:] if p.startswith(_FIRST) else p for p in new])
            ids = [i[1:] if p[:1] == "\n" and not p.startswith(_FIRST) else i for i, p in zip(ids, new)]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum()))])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
            new.clear()
            return
        spelled = [_spelled(p) if p[:1] == "\n" else " " + p for p in new]
        plain = [(p[:1] != "\n" or not p.startswith((_FIRST, _GLUED))) and len(p.split()) == 1
                 and not p[-1].isspace() for p in new]
        words = [w for w, is_plain in zip(spelled, plain) if is_plain]
        alone = [w for w, is_plain in zip(spelled, plain) if not is_plain]
        new.clear()
        sizes = np.zeros(len(spelled), np.int64)
        is_plain = np.array(plain, bool)
        flat_words, _ = self._flat(["".join(words[k:k + LINE]) for k in range(0, len(words), LINE)])
        word_ends = np.cumsum(pc.binary_length(pa.array(words, pa.string())).to_numpy(), dtype=np.int64)
        upto = np.searchsorted(np.cumsum(self.widths[flat_words]), word_ends, "right")
        sizes[is_plain] = np.diff(np.r_[0, upto])
        flat_alone, sizes[~is_plain] = self._flat(alone)
        flat = np.zeros(int(sizes.sum()), np.uint32)
        of_words = np.repeat(is_plain, sizes)
        flat[of_words] = flat_words
        flat[~of_words] = flat_alone
        self.flat = np.concatenate([self.flat, flat])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])

    def _part_numbers(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the parts of the texts one after another, and how many each has.

        Distinct words are found by Arrow, so only those of a chunk become Python strings.
        """
        number = self.parts.__getitem__
        special = np.zeros(len(texts), bool)
        for content in self.added:
            special |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        odd = special | pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False)
        counts = np.zeros(len(texts), np.int64)
        lists = _parts_of_plain(texts.filter(pa.array(~odd)), self.added != [_MARK])
        words = lists.flatten().dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False)  # to_pylist takes ten times as long
        numbers = np.fromiter(map(number, distinct), np.int64, len(distinct))
        plain = numbers[words.indices.to_numpy()]
        counts[~odd] = np.diff(lists.offsets.to_numpy())
        if not odd.any():
            return plain, counts
        others = [list(map(number, [_FIRST + t] if whole else _parts_of_odd(t)))
                  for t, whole in zip(texts.filter(pa.array(odd)).to_pylist(), special[odd].tolist())]
        counts[odd] = np.fromiter(map(len, others), np.int64, len(others))
        part = np.zeros(int(counts.sum()), np.int64)
        of_odd = np.repeat(odd, counts)
        part[~of_odd] = plain
        part[of_odd] = np.fromiter(chain.from_iterable(others), np.int64)
        return part, counts

    def _chunk(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not self.by_parts:
            return self._flat(texts.to_pylist())
        if len(self.parts) > self.known_parts:
            self._forget()
        part, counts = self._part_numbers(texts)
        if self.parts.new:
            self._learn()
        lengths = self.starts[part + 1] - self.starts[part]
        ends = np.cumsum(lengths)
        at = np.repeat(self.starts[part] - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)
        upto = np.r_[0, ends][np.cumsum(counts)]
        return self.flat[at], np.diff(np.r_[0, upto])

    def encode(self, texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Flat ids and the number of ids per text, for some texts at a time; null is empty.

        texts: a list or an Arrow column.
        """
        column = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        column = pc.fill_null(column, "")
        sizes = np.cumsum(pc.binary_length(column).to_numpy())
        begin = 0
        while begin < len(column):
            before = int(sizes[begin - 1]) if begin else 0
            end = min(int(np.searchsorted(sizes, before + CHUNK_BYTES)) + 1, len(column))
            told = self._chunk(column.slice(begin, end - begin))
            pa.default_memory_pool().release_unused()  # Arrow keeps what chunks have freed
            yield told
            begin = end

    def sentence_ends(self) -> np.ndarray:
        """By id: whether a sentence or line may end after the token."""
        return np.array([v.endswith((".", "!", "?", "\n", "Ċ", "<0x0A>")) for v in self.vocabulary], bool)


@lru_cache(maxsize=2)
def encoder(path: str, as_text: bool = False, known_parts: int = KNOWN_PARTS) -> Encoder:
    """The encoder of a file, loaded once per Python worker."""
    return Encoder(path, as_text, known_parts)


def version(path: str) -> str:
    """A digest of the tokenizer's file and of its library's version."""
    if path.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    with open(path, "rb") as file:
        return hashlib.sha256(f"{library.__name__} {library.__version__}\n".encode() + file.read()).hexdigest()


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
