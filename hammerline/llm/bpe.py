"""Byte-level BPE by a pair occurrence index, and the way back.

The texts of a batch are cut into pieces by the tokenizer's own pattern; each distinct piece not
met before is put, byte by byte, into one array. An index maps every pair's rank to all the
positions where the pair stands. The active ranks are applied in ascending order: a rank's
positions are merged together, and only the pairs beside a merge are entered anew under their
ranks. As the array holds distinct pieces of many texts, one pass over the ranks serves all.

Ids are those of the ``tokenizers`` library for the same file without special tokens added,
strings of added tokens in a text included. The vocabulary (about a megabyte) travels with the
function; executors need neither the file nor the library.

Defined cases: NULL text is the empty text, which has no ids; texts of any length are encoded
whole; repeated rows are encoded alike; an empty table gives an empty result; other columns are
not touched.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hammerline.llm.texts import filled

# Fixed value: the pattern by which byte-level tokenizers of this family cut a text.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
# New pieces are merged in lots of about so many bytes, and so many pieces are remembered.
LOT_BYTES = 8 << 20
REMEMBERED = 400_000
# A piece this long is not remembered.
LONG_PIECE = 256


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a vocabulary file: printable Latin-1 characters for
    themselves, the other bytes as the characters from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Ids, merges and added tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        ids = spec["model"]["vocab"]
        size = 1 + max([*ids.values(), *(t["id"] for t in spec["added_tokens"])])
        self.tokens: list[bytes] = [b""] * size
        for token, i in ids.items():
            self.tokens[i] = bytes(letters[c] for c in token)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for content, i in self.added.items():
            self.tokens[i] = content.encode()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.left = np.array([ids[a] for a, _ in pairs], dtype=np.int64)
        self.right = np.array([ids[b] for _, b in pairs], dtype=np.int64)
        self.made = np.array([ids[a + b] for a, b in pairs], dtype=np.int64)
        self.bytes = np.zeros(256, dtype=np.int64)
        for letter, b in letters.items():
            self.bytes[b] = ids[letter]
        keys = self.left * size + self.right
        self.rank_of = np.argsort(keys, kind="stable")
        self.keys, self.size = keys[self.rank_of], size


def ranks(vocabulary: Vocabulary, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Merge ranks of pairs of ids, -1 where there is none."""
    wanted = left * vocabulary.size + right
    at = np.minimum(np.searchsorted(vocabulary.keys, wanted), len(vocabulary.keys) - 1)
    return np.where(vocabulary.keys[at] == wanted, vocabulary.rank_of[at], -1)


def merge_all(vocabulary: Vocabulary, pieces: list[bytes]) -> list[bytes]:
    """The ids of each piece, as the bytes of 32-bit integers."""
    sizes = np.array([len(p) for p in pieces], dtype=np.int64)
    ids = vocabulary.bytes[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
    n = len(ids)
    ends = np.cumsum(sizes)
    last = np.zeros(n + 1, dtype=bool)
    last[ends - 1] = True
    # The next live position, and the one before; n and -1 stand for the borders of a piece.
    after = np.where(last[:n], n, np.arange(1, n + 1))
    before = np.arange(-1, n - 1)
    before[np.concatenate([[0], ends[:-1]])] = -1
    index: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def enter(at: np.ndarray) -> None:
        rank = ranks(vocabulary, ids[at], ids[after[at]])
        known = rank >= 0
        at, rank = at[known], rank[known]
        if not len(at):
            return
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        cuts = np.flatnonzero(np.diff(rank)) + 1
        for r, positions in zip(rank[np.concatenate([[0], cuts])].tolist(), np.split(at, cuts)):
            if r not in index:
                index[r] = []
                heapq.heappush(active, r)
            index[r].append(positions)

    enter(np.flatnonzero(~last[:n]))
    while active:
        r = heapq.heappop(active)
        lists = index.pop(r)
        at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
        left, right = vocabulary.left[r], vocabulary.right[r]
        following = after[at]
        good = (ids[at] == left) & (following < n)
        good[good] &= ids[following[good]] == right
        at, following = at[good], following[good]
        if left == right and len(at) > 1:
            # In a run of touching pairs every second one is taken, from the left.
            at.sort()
            following = after[at]
            starts = np.concatenate([[True], following[:-1] != at[1:]])
            nth = np.arange(len(at)) - np.maximum.accumulate(np.where(starts, np.arange(len(at)), 0))
            at, following = at[nth % 2 == 0], following[nth % 2 == 0]
        if not len(at):
            continue
        beyond = after[following]
        ids[at] = vocabulary.made[r]
        ids[following] = -1
        after[at] = beyond
        inner = beyond < n
        before[beyond[inner]] = at[inner]
        previous = before[at]
        enter(np.unique(np.concatenate([at[inner], previous[previous >= 0]])))
    live = ids >= 0
    stops = (4 * np.cumsum(live)[ends - 1]).tolist()
    packed = ids[live].astype("<i4").tobytes()
    return [packed[a:b] for a, b in zip([0, *stops], stops)]


class Encoder:
    """Encodes texts, remembering the ids of a bounded number of pieces."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.known: dict[str, bytes] = {}
        self.find = regex.compile(PATTERN).findall
        added = sorted(vocabulary.added, key=len, reverse=True)
        self.added = regex.compile("(" + "|".join(map(regex.escape, added)) + ")") if added else None

    def pieces(self, text: str) -> list[str]:
        """The pieces of a text; an added token is a piece of its own."""
        if self.added is None or not self.added.search(text):
            return self.find(text)
        out = []
        for part in self.added.split(text):
            out += [part] if part in self.vocabulary.added else self.find(part)
        return out

    def learn(self, new: list[str]) -> dict[str, bytes]:
        found, lot, size = {}, [], 0
        for i, piece in enumerate(new):
            lot.append(piece)
            size += len(piece)
            if size >= LOT_BYTES or i == len(new) - 1:
                found |= zip(lot, merge_all(self.vocabulary, [p.encode("utf-8", "replace") for p in lot]))
                lot, size = [], 0
        return found

    def encode_all(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text, in order."""
        if len(self.known) > REMEMBERED:
            self.known = {}
        cut = [self.pieces(t) for t in texts]
        new = set().union(*cut).difference(self.known, self.vocabulary.added)
        once = self.learn(list(new))
        self.known |= {p: i for p, i in once.items() if len(p) < LONG_PIECE}
        look = self.known | {p: i for p, i in once.items() if len(p) >= LONG_PIECE} if once else self.known
        for content, i in self.vocabulary.added.items():
            look[content] = i.to_bytes(4, "little")
        for pieces in cut:
            yield np.frombuffer(b"".join(map(look.__getitem__, pieces)), dtype="<i4")


def lots(texts: pd.Series, most: int = LOT_BYTES) -> Iterator[list[str]]:
    """A batch in lists of about so many characters."""
    lot, size = [], 0
    for text in texts:
        lot.append(text)
        size += len(text)
        if size >= most:
            yield lot
            lot, size = [], 0
    if lot:
        yield lot


def decode_one(ids: np.ndarray, tokens: list[bytes]) -> str:
    return b"".join(map(tokens.__getitem__, ids.tolist())).decode("utf-8", "replace")


def encode(text: Column, path: str) -> Column:
    """The ids of each text, as an array of integers."""
    vocabulary = Vocabulary(path)

    @F.pandas_udf("array<int>")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            yield pd.Series([ids for lot in lots(batch) for ids in encoder.encode_all(lot)], dtype=object)

    return udf(filled(text))


def decode(ids: Column, path: str) -> Column:
    """The text of each array of ids, special tokens included; NULL ids give the empty text."""
    tokens = Vocabulary(path).tokens

    @F.pandas_udf("string")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([decode_one(np.asarray(x), tokens) for x in batch], dtype=object)

    return udf(F.coalesce(ids, F.array().cast("array<int>")))


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row the id, n_tokens, and digests of the ids and of the text decoded from them.

    Encoding and decoding share one pass, so ids don't travel between the two.
    """
    vocabulary = Vocabulary(path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, tokens = Encoder(vocabulary), vocabulary.tokens
        written = list(map(str, range(vocabulary.size)))
        sha = lambda text: hashlib.sha256(text.encode("utf-8", "replace")).hexdigest()
        for batch in batches:
            rows = []
            for lot in lots(batch["text"]):
                for ids in encoder.encode_all(lot):
                    listed = ",".join(map(written.__getitem__, ids.tolist()))
                    rows.append((len(ids), sha(listed), sha(decode_one(ids, tokens))))
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            out.insert(0, "id", batch["id"].to_numpy())
            yield out

    narrow = docs.select(F.col(id_col).alias("id"), filled(text_col).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    keyed = narrow.mapInPandas(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return keyed.withColumnRenamed("id", id_col)
