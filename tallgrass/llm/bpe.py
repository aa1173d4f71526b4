"""Byte-level BPE encoding and decoding, with tree concatenation for long unsplit text.

A text splits exactly before a space that stands between two characters that
are no white space: no pre-token crosses such a place, and none looks past it.
Long texts are encoded in parts that end there.  Pre-tokens repeat, so their ids
are kept in a bounded memo; a new one goes through the tokenizer's own BPE model.
Text beyond Latin-1 goes piece by piece (a memo again) through the tokenizer's
own pre-tokenizer.

A pre-token longer than ``LEAF`` bytes has no place to split.  It is halved
down to leaves, which are encoded as one parallel batch of the tokenizers
library; then neighbours are joined pair by pair.  A join re-encodes a window
around the seam.  If the window holds a token that the left side has at the
same place, and one that the right side has, then left tokens up to the first,
window tokens between, and right tokens from the second form the encoding of
the whole: adjacent tokens of a BPE encoding stay an encoding wherever every
adjacent pair is one, and here each pair stands in one of the three.  Else the
window doubles, at most to both sides in full.

Defined results: null and empty texts have no tokens and decode to ''; texts
of any length work, with memory in proportion to one text; repeated rows are
encoded alike; ids are those of ``encode(text, add_special_tokens=False)``
with the file's truncation and padding unused, where the strings of added
tokens get their own ids; extra columns are kept by ``encode_documents`` and
ignored by the digest; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from struct import pack

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from tallgrass.llm.common import few_arrow_rows

LEAF = 2_048
WINDOW = 32
#: Entries of each memo before it starts anew.
MEMO = 400_000
#: Bytes of text that are encoded together.
GATHER = 8 << 20
#: Pieces beyond this many characters are not kept.
MEMO_CHARS = 64

#: A text beyond this many characters is encoded in parts.
PART_CHARS = 1 << 16

_CUT = re.compile(r"(?<=\S)(?= \S)")
# The byte-level pre-token pattern, its classes written out for
# texts of Latin-1 alone (any other text takes the library's pre-tokenizer).
_LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
_SPACES = "\x20\t-\r\x85\xa0"
_PRE_LATIN1 = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^{_SPACES}{_LETTERS}{_NUMBERS}]+"
    f"|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _byte_symbols() -> dict[int, int]:
    """Byte -> code point of its printable symbol in byte-level vocabularies:
    printable Latin-1 stands for itself, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 256 + i for i, b in enumerate(rest)}


class _Memo(dict):
    """Ids of strings met before, of ``MEMO`` strings at most; longer ones than ``MEMO_CHARS`` are not kept."""

    def __init__(self, make: Callable[[str], bytes]) -> None:
        super().__init__()
        self.make = make

    def __missing__(self, key: str) -> bytes:
        ids = self.make(key)
        if len(key) <= MEMO_CHARS:
            if len(self) >= MEMO:
                self.clear()
            self[key] = ids
        return ids


def _is_latin1(text: str) -> bool:
    try:
        text.encode("latin-1")
        return True
    except UnicodeEncodeError:
        return False


def _parts(text: str) -> Iterator[str]:
    """A text in parts of about ``PART_CHARS`` characters (more if it has no place to split)."""
    at = 0
    while cut := _CUT.search(text, at + PART_CHARS):
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


def _u4(ids: list[int]) -> bytes:
    return pack(f"<{len(ids)}I", *ids)


class Codec:
    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.raw = Tokenizer(self.model)  # BPE without a pre-tokenizer's split
        self.raw.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.symbols = _byte_symbols()
        back = {chr(v): k for k, v in self.symbols.items()}
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes_of = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        self.decimal = [str(i) for i in range(len(self.bytes_of))]
        self.added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.added_re = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.pre = _Memo(self._pre_token)
        self.pieces = _Memo(self._piece)

    # -- encoding ---------------------------------------------------------
    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<u4").tolist()

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(self.encode_bytes(t), "<u4") for t in texts]

    def encode_bytes(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if not any(a in text for a in self.added):
            return self._plain(text)
        return b"".join(_u4([self.added[part]]) if part in self.added else self._plain(part)
                        for part in self.added_re.split(text))

    def _plain(self, text: str) -> bytes:
        """Text without added tokens."""
        return self._part(text) if len(text) <= PART_CHARS else b"".join(map(self._part, _parts(text)))

    def _part(self, text: str) -> bytes:
        if _is_latin1(text):
            return b"".join(map(self.pre.__getitem__, _PRE_LATIN1.findall(text)))
        # the library's pre-tokenizer is slow: only new pieces go there
        return b"".join(map(self.pieces.__getitem__, _CUT.split(text)))

    def _piece(self, piece: str) -> bytes:
        return b"".join(map(self.pre.__getitem__, self._pre_tokens(piece)))

    def _pre_tokens(self, text: str) -> list[str]:
        if _is_latin1(text):
            return _PRE_LATIN1.findall(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def _pre_token(self, piece: str) -> bytes:
        if len(piece) > LEAF // 4 and len(piece.encode()) > LEAF:
            return _u4(self.tree(piece))
        symbols = piece.encode().decode("latin-1").translate(self.symbols)
        return _u4([t.id for t in self.model.tokenize(symbols)])

    def tree(self, piece: str, leaf: int = LEAF, window: int = WINDOW) -> list[int]:
        """Ids of one unsplit piece by tree concatenation."""
        step = max(1, leaf // 4)  # characters have up to four bytes
        texts = [piece[i:i + step] for i in range(0, len(piece), step)]
        parts = [(t, e.ids) for t, e in zip(texts, self.raw.encode_batch(texts, add_special_tokens=False))]
        while len(parts) > 1:
            joined = [self._join(*parts[i], *parts[i + 1], window) for i in range(0, len(parts) - 1, 2)]
            parts = joined + parts[len(joined) * 2:]
        return parts[0][1]

    def _spans(self, ids: list[int], at: int) -> dict[tuple[int, int], int]:
        """(start byte, id) -> place in ids."""
        ends = np.cumsum([len(self.bytes_of[i]) for i in ids]) + at
        return {(int(e) - len(self.bytes_of[i]), i): k for k, (e, i) in enumerate(zip(ends, ids))}

    def _join(self, left: str, lids: list[int], right: str, rids: list[int], window: int) -> tuple[str, list[int]]:
        while True:
            lw, rw = left[-window:], right[:window]
            mid = self.raw.encode(lw + rw, add_special_tokens=False).ids
            if len(lw) == len(left) and len(rw) == len(right):
                return left + right, mid
            # only tokens within the window's reach are compared; byte 0 is the seam
            lcut = self._tail(lids, len(lw.encode()))
            rcut = self._head(rids, len(rw.encode()))
            lspan = self._spans(lids[lcut:], -sum(len(self.bytes_of[i]) for i in lids[lcut:]))
            rspan = self._spans(rids[:rcut], 0)
            places = self._spans(mid, -len(lw.encode()))
            a = next(((m, lcut + lspan[x]) for x, m in places.items() if x in lspan), None)
            b = next(((m, rspan[x]) for x, m in reversed(places.items()) if x in rspan), None)
            whole_l, whole_r = len(lw) == len(left), len(rw) == len(right)
            if (a or whole_l) and (b or whole_r):
                m0, l0 = a if a else (-1, -1)
                m1, r0 = b if b else (len(mid), len(rids))
                return left + right, lids[:l0 + 1] + mid[m0 + 1:m1] + rids[r0:]
            window *= 2

    def _tail(self, ids: list[int], size: int) -> int:
        n, k = 0, len(ids)
        while k and n < size:
            k -= 1
            n += len(self.bytes_of[ids[k]])
        return k

    def _head(self, ids: list[int], size: int) -> int:
        n, k = 0, 0
        while k < len(ids) and n < size:
            n += len(self.bytes_of[ids[k]])
            k += 1
        return k

    # -- decoding ---------------------------------------------------------
    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")

    def digest(self, ids: list[int]) -> str:
        return hashlib.sha256(",".join(map(self.decimal.__getitem__, ids)).encode()).hexdigest()


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def gathered(batches: Iterator[pa.RecordBatch], size: int = GATHER) -> Iterator[tuple[pa.Array, list[str]]]:
    """(first column, texts of the second) of about ``size`` characters at a time."""
    keys, texts, held = [], [], 0
    for batch in batches:
        keys.append(batch.column(0))
        texts.extend(batch.column(1).to_pylist())
        held += batch.column(1).nbytes
        if held >= size:
            yield pa.concat_arrays(keys), texts
            keys, texts, held = [], [], 0
    if keys:
        yield pa.concat_arrays(keys), texts


def encode_column(text: Column, path: str | None = None) -> Column:
    """array<int> of the ids; null and empty texts give an empty array."""
    path = path or tokenizer_path()

    @F.pandas_udf(ArrayType(IntegerType()))
    def encode(s):
        c = codec(path)
        return pd.Series([x.tolist() for x in c.encode_batch([t or "" for t in s])], index=s.index, dtype=object)
    return encode(F.coalesce(text, F.lit("")))


def decode_column(ids: Column, path: str | None = None) -> Column:
    """Text of the ids; null ids give ''."""
    path = path or tokenizer_path()

    @F.pandas_udf(StringType())
    def decode(s):
        c = codec(path)
        return s.map(lambda x: c.decode([] if x is None else list(x)))
    return decode(ids)


def encode_documents(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """``docs`` plus token_ids and n_tokens."""
    few_arrow_rows(docs.sparkSession)
    out = docs.withColumn("token_ids", encode_column(F.col(text), path))
    return out.withColumn("n_tokens", F.size("token_ids").cast("long"))


def round_trip(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: ids and decoded texts stay in the task."""
    path = path or tokenizer_path()
    few_arrow_rows(docs.sparkSession)
    own = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = own.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for keys, texts in gathered(batches):
            n, ids_sha, text_sha = [], [], []
            for found in c.encode_batch(texts):
                ids = found.tolist()
                n.append(len(ids))
                ids_sha.append(c.digest(ids))
                text_sha.append(hashlib.sha256(c.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return own.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
