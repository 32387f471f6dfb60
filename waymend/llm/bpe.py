"""Byte-level BPE: speculate and verify.

A text is cut into words; each new word is first cut greedily into the longest tokens that
match. A sequence of tokens is what exact merging would give if and only if each adjacent
pair is compatible, that is, if no merge across the border of the two would have come
before the merges that built them. All pairs of all new words of a block are tested at
once with numpy; only words with a failing pair are merged exactly. Words are remembered
(up to a bound), so the work grows with the number of new words.

The vocabulary is a tokenizer file whose path is a parameter; the driver reads it and Spark
sends it to the tasks (its size does not depend on the data).

Defined cases: null is the empty text and has no tokens; strings of added tokens (such as
<|endoftext|>) become their ids wherever they occur, as in the tokenizers library; texts of
any length are worked off in pieces; repeated rows are encoded each; columns of the input
are kept, and a clashing output name gets underscores behind it.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections import ChainMap
from collections.abc import Iterable, Iterator
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from waymend.llm.common import free_name

#: How the byte-level scheme cuts words. Fixed value of the scheme.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters worked on at a time, longest word to remember, words to remember.
PIECE, LONG_WORD, REMEMBERED = 1_000_000, 64, 400_000
NEVER = np.iinfo(np.int64).max
#: Stands between words in the automaton's input; no byte does.
BORDER = "\u0100"


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a vocabulary file, by the scheme's rule:
    visible Latin-1 characters stand for themselves, the others for 256, 257, ... in order."""
    letters, spare = {}, 256
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or 174 <= byte <= 255:
            letters[chr(byte)] = byte
        else:
            letters[chr(spare)] = byte
            spare += 1
    return letters


class Vocabulary:
    """Tokens and merges of a byte-level BPE file, with what the verification needs."""

    def __init__(self, content: str):
        file = json.loads(content)
        model = file["model"]
        if model["type"] != "BPE" or (file.get("pre_tokenizer") or {}).get("type") != "ByteLevel":
            raise ValueError("not a byte-level BPE file")
        letters = byte_letters()
        ids = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items()}
        self.added = {}
        for x in file.get("added_tokens") or []:
            if x["single_word"] or x["lstrip"] or x["rstrip"] or x["normalized"]:
                raise ValueError(f"added token of an unsupported kind: {x['content']}")
            self.added[x["content"]] = x["id"]
        size = 1 + max([*ids.values(), *self.added.values()])
        self.size = size
        self.token_bytes = [b""] * size
        for token, i in ids.items():
            self.token_bytes[i] = token
        for token, i in self.added.items():
            self.token_bytes[i] = token.encode()
        self.byte_ids = [ids[bytes([b])] for b in range(256)]

        # rank, left and right part of each token; bytes have none (-1).
        self.rank = np.full(size, -1, np.int64)
        self.left = np.full(size, -1, np.int64)
        self.right = np.full(size, -1, np.int64)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        plain = np.ones(size, bool)
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            a, b = (bytes(letters[c] for c in x) for x in (a, b))
            l, r, made = ids[a], ids[b], ids[a + b]
            self.merges[l, r] = (rank, made)
            if self.left[made] >= 0 or len(a + b) == 1:
                plain[made] = False  # made in two ways: its history is not known
            self.rank[made], self.left[made], self.right[made] = rank, l, r
        merged = np.flatnonzero(self.left >= 0)
        early = (self.rank[self.left[merged]] >= self.rank[merged]) | (self.rank[self.right[merged]] >= self.rank[merged])
        plain[merged[early]] = False
        keys = np.array([l * size + r for l, r in self.merges], np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.key_ranks, self.made = np.array([*self.merges.values()], np.int64)[order].T.copy()
        # Only tokens whose own parts are compatible can stand in a result.
        border = np.zeros(size, bool)
        border[merged] = True
        usable = plain & (border | (self.left < 0))
        inner = merged[plain[merged]]
        usable[inner[~self._crossing_is_own(inner)]] = False
        proposals = {token: i for token, i in ids.items() if usable[i] and (self.left[i] >= 0 or len(token) == 1)}
        self.sizes = np.array([len(t) for t in self.token_bytes], np.int64)
        self.byte_table = np.array(self.byte_ids, np.int64)
        self.automaton = ahocorasick.Automaton()
        for token, i in proposals.items():
            self.automaton.add_word(token.decode("latin-1"), i)
        self.automaton.make_automaton()

    def _crossing_is_own(self, tokens: np.ndarray) -> np.ndarray:
        """Whether exact merging of a token's two parts side by side joins them, and nothing earlier."""
        return ~self._earlier_merge(self.left[tokens], self.right[tokens], self.rank[tokens])

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether token b can follow token a in an exactly merged word."""
        return ~self._earlier_merge(a, b, np.full(len(a), NEVER))

    def _earlier_merge(self, a: np.ndarray, b: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Whether a merge across the border comes while both of its parts still stand alone.

        The parts at a's right edge are a, its right part, that one's right part and so on;
        each stands until the next larger one is merged. The same holds for b's left edge.
        At equal ranks the merge further left comes first. ``before``: when a and b end.
        """
        found = np.zeros(len(a), bool)
        x, x_until, rows = a, before, np.arange(len(a))
        while len(rows):
            y, y_until, at = b[rows], before[rows], np.arange(len(rows))
            first = True
            while len(at):
                key = x[at] * self.size + y
                i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                rank = np.where(self.keys[i] == key, self.key_ranks[i], NEVER)
                hit = (rank < x_until[at]) & ((rank < y_until) if first else (rank <= y_until))
                found[rows[at[hit]]] = True
                go = ~hit & (self.left[y] >= 0)
                at, y_until, y, first = at[go], self.rank[y[go]], self.left[y[go]], False
            go = ~found[rows] & (self.right[x] >= 0)
            rows, x_until, x = rows[go], self.rank[x[go]], self.right[x[go]]
        return found

    def propose(self, raw: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Longest match from left to right, of all words at once: the tokens, and whose they are.

        A word that no sequence of proposals covers gets none.
        """
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        ends = np.cumsum(sizes + 1)  # with the border that follows each word
        found = np.fromiter(
            (v for pair in self.automaton.iter_long(BORDER.join(raw)) for v in pair), np.int64
        ).reshape(-1, 2)
        owner = np.searchsorted(ends, found[:, 0], side="right")
        covered = np.bincount(owner, weights=self.sizes[found[:, 1]], minlength=len(raw)) == sizes
        keep = covered[owner]
        return found[keep, 1], owner[keep]

    def merge(self, tokens: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of many words at once: in each round every word makes its merge of the
        lowest rank, the leftmost of equal ones. ``tokens`` are bytes' ids, ``owner`` ascends."""
        done_tokens, done_owner = [], []
        while len(tokens):
            key = np.append(tokens[:-1] * self.size + tokens[1:], -1)
            i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            same = np.append(owner[1:] == owner[:-1], False) & (self.keys[i] == key)
            rank = np.where(same, self.key_ranks[i], NEVER)
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            word = np.cumsum(np.bincount(starts, minlength=len(tokens))) - 1
            least = np.minimum.reduceat(rank, starts)
            going = least[word] < NEVER
            done_tokens.append(tokens[~going])
            done_owner.append(owner[~going])
            # The leftmost position that has its word's lowest rank.
            best = np.flatnonzero(going & (rank == least[word]))
            best = best[np.append(True, word[best[1:]] != word[best[:-1]])] if len(best) else best
            tokens = tokens.copy()
            tokens[best] = self.made[i[best]]
            going[best + 1] = False
            tokens, owner = tokens[going], owner[going]
        tokens, owner = np.concatenate([*done_tokens, tokens]), np.concatenate([*done_owner, owner])
        order = np.argsort(owner, kind="stable")
        return tokens[order], owner[order]

    def merge_long(self, word: bytes) -> list[int]:
        """The same for one long word, with a queue."""
        ids: list[int] = [self.byte_ids[b] for b in word]
        n = len(ids)
        after, prior = [*range(1, n), -1], [*range(-1, n - 1)]
        queue: list[tuple[int, int, int, int, int]] = []

        def offer(p: int, q: int) -> None:
            if found := self.merges.get((ids[p], ids[q])):
                heapq.heappush(queue, (found[0], p, ids[p], ids[q], found[1]))

        for i in range(n - 1):
            offer(i, i + 1)
        while queue:
            _, i, l, r, made = heapq.heappop(queue)
            j = after[i]
            if ids[i] != l or j < 0 or ids[j] != r:
                continue  # one of the two is gone
            ids[i], ids[j], after[i] = made, -1, after[j]
            if after[j] >= 0:
                prior[after[j]] = i
                offer(i, after[j])
            if prior[i] >= 0:
                offer(prior[i], i)
        return [i for i in ids if i >= 0]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids (little-endian, 32 bits) of each word."""
        if not words:  # a slice whose words are all known, or that has none
            return []
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        tokens, owner = self.propose([w.decode("latin-1") for w in raw])
        failing = np.ones(len(words), bool)
        failing[owner] = False
        pairs = np.flatnonzero(owner[1:] == owner[:-1])
        distinct, back = np.unique(tokens[pairs] * self.size + tokens[pairs + 1], return_inverse=True)
        good = self.compatible(distinct // self.size, distinct % self.size)[back]
        failing[owner[pairs[~good]]] = True
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        short = np.flatnonzero(failing & (sizes <= LONG_WORD))
        spelled = np.frombuffer(b"".join(raw[i] for i in short), np.uint8)
        more, whose = self.merge(self.byte_table[spelled], np.repeat(short, sizes[short]))
        keep = ~failing[owner]
        tokens, owner = np.concatenate([tokens[keep], more]), np.concatenate([owner[keep], whose])
        tokens = tokens[np.argsort(owner, kind="stable")].astype("<u4").tobytes()
        ends = 4 * np.cumsum(np.bincount(owner, minlength=len(words)))
        out = [tokens[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
        for i in np.flatnonzero(failing & (sizes > LONG_WORD)):
            out[i] = np.array(self.merge_long(raw[i]), "<u4").tobytes()
        return out


class Coder:
    """Encodes and decodes texts; holds the words it has seen."""

    def __init__(self, content: str):
        self.vocabulary = Vocabulary(content)
        self.words = regex.compile(WORDS)
        self.known: dict[str, bytes] = {}
        added = sorted(self.vocabulary.added, key=len, reverse=True)
        self.added = regex.compile("(" + "|".join(map(regex.escape, added)) + ")") if added else None

    def pieces(self, text: str) -> Iterator[list[str] | bytes]:
        """Lists of words, and the ids of added tokens, in the order of the text."""
        parts = self.added.split(text) if self.added else [text]
        for i, part in enumerate(parts):
            if i % 2:
                yield np.array([self.vocabulary.added[part]], "<u4").tobytes()
            elif len(part) <= PIECE:
                yield self.words.findall(part)
            else:
                found = (m.group() for m in self.words.finditer(part))
                while some := list(islice(found, PIECE // 4)):
                    yield some

    def learn(self, lists: Iterable[list[str]]) -> dict[str, bytes]:
        """Make sure that all these words are known; returns the long ones, which are not kept."""
        fresh = set().union(*lists).difference(self.known)
        if len(self.known) + len(fresh) > REMEMBERED:
            self.known.clear()
            fresh = set().union(*lists)
        fresh = list(fresh)
        coded = dict(zip(fresh, self.vocabulary.encode_words(fresh), strict=True))
        long = {w: coded.pop(w) for w in fresh if len(w) > LONG_WORD}
        self.known.update(coded)
        return long

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, as little-endian 32-bit numbers."""
        out, at = [], 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size < PIECE):
                size += len(texts[end] or "")
                end += 1
            if end == at + 1 and size > PIECE:
                out.append(b"".join(self._coded([x]) if isinstance(x, list) else x for x in self.pieces(texts[at])))
            else:
                parts = [list(self.pieces(t or "")) for t in texts[at:end]]
                long = self.learn([x for p in parts for x in p if isinstance(x, list)])
                get = self.known if not long else ChainMap(self.known, long)
                for p in parts:
                    out.append(b"".join(b"".join(map(get.__getitem__, x)) if isinstance(x, list) else x for x in p))
            at = end
        return out

    def _coded(self, lists: list[list[str]]) -> bytes:
        long = self.learn(lists)
        get = ChainMap(self.known, long)
        return b"".join(get[w] for words in lists for w in words)

    def decode(self, ids: bytes | None) -> str:
        tokens = np.frombuffer(ids or b"", "<u4").tolist()
        return b"".join(map(self.vocabulary.token_bytes.__getitem__, tokens)).decode("utf-8", "replace")


def _mapped(docs: DataFrame, tokenizer: str, column: str, made: dict[str, T.DataType], work) -> DataFrame:
    """``docs`` with the columns that ``work(coder, values)`` makes of ``column``."""
    with open(tokenizer, encoding="utf-8") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())
    names = [free_name(docs, name) for name in made]
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, t) for n, t in zip(names, made.values(), strict=True)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(content.value)
        for batch in batches:
            # Few texts at a time: what they become stays small next to the batch.
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                new = work(coder, part.column(part.schema.get_field_index(column)).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*part.schema.names, *names])

    return docs.mapInArrow(run, schema)


def id_lists(ids: list[bytes]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(i) // 4 for i in ids])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int32)))


def encode(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """Adds ``token_ids`` (array of int) and ``n_tokens`` (long)."""

    def work(coder: Coder, texts):
        ids = coder.encode(texts)
        return [id_lists(ids), pa.array([len(i) // 4 for i in ids], pa.int64())]

    return _mapped(docs, tokenizer, text_col, {"token_ids": T.ArrayType(T.IntegerType()), "n_tokens": T.LongType()}, work)


def decode(docs: DataFrame, tokenizer: str, ids_col: str = "token_ids") -> DataFrame:
    """Adds ``decoded`` (string) from an array of ids; null is the empty text."""

    def work(coder: Coder, lists):
        return [pa.array([coder.decode(np.array(x or [], "<u4").tobytes()) for x in lists], pa.string())]

    return _mapped(docs, tokenizer, ids_col, {"decoded": T.StringType()}, work)


def encode_and_decode(docs: DataFrame, tokenizer: str, text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Adds n_tokens, ids_sha256 and decoded_sha256 (and token_ids if asked): each text encoded,
    then decoded from its ids again."""

    def work(coder: Coder, texts):
        ids = coder.encode(texts)
        return [
            pa.array([len(i) // 4 for i in ids], pa.int64()),
            pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
            pa.array([hashlib.sha256(coder.decode(i).encode()).hexdigest() for i in ids], pa.string()),
            *([id_lists(ids)] if with_ids else []),
        ]

    made = {"n_tokens": T.LongType(), "ids_sha256": T.StringType(), "decoded_sha256": T.StringType()}
    if with_ids:
        made["token_ids"] = T.ArrayType(T.IntegerType())
    return _mapped(docs, tokenizer, text_col, made, work)
