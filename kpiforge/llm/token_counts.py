"""Exact token counts of every prefix, by dynamic programming over a byte-level BPE vocabulary.

The pre-tokenizer's pattern cuts a text into pieces, and no token crosses a piece.  Inside a piece
the last token of each prefix's encoding follows from shorter prefixes: it is the token t that ends
there, is its own encoding, and stands next to the last token of what is left without being merged
with any part of it.  So ``count[i] = count[i - len(t)] + 1``, in time linear in the piece for a
bounded token length; a long run without white space costs no more per byte than prose.

A text's store is one signed byte per text byte: the change of the count from prefix to prefix.  A
running sum answers how many tokens any prefix has, and where a text must be cut to fit a budget,
without encoding anything again.  Pieces recur, so each worker keeps the changes of pieces it has
seen, at most ``CACHE_PIECES`` of them (it is emptied when full; the answers do not depend on it).

Vocabulary, merges and added tokens are read from the tokenizer file; its path is a parameter.  The
pattern is the fixed one of byte-level files; a file that asks for another, or for a normaliser, a
prefix or merge rules beyond the plain ones, is refused.

Defined cases: a null text counts as empty and has 0 tokens; prefixes that end inside a character
have the count of the last whole character; ids and repeated rows play no part; an empty table
gives no rows.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHE_PIECES = 300_000
CACHE_BYTES = 64 << 20
MAX_PAIRS = 400_000
NEVER = 1 << 60
# fixed values: the pre-tokenizer's pattern of the byte-level BPE files (white space by Unicode property)
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
# the same for texts below U+0250, with the classes written out for the faster built-in module
_L, _N, _S = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", r"0-9\xb2\xb3\xb9\xbc-\xbe", r"\t-\r \x85\xa0"
LATIN_PATTERN = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")


def byte_letters() -> dict[str, int]:
    """The letter that byte-level files write for each byte: itself if printable, else the next from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown}
    hidden = [b for b in range(256) if b not in set(shown)]
    letters.update({chr(256 + i): b for i, b in enumerate(hidden)})
    return letters


def refuse_other_rules(spec: dict) -> None:
    """Raise ValueError unless the file is plain byte-level BPE, whose counts are exact here."""
    before, model = spec.get("pre_tokenizer") or {}, spec["model"]
    added = spec.get("added_tokens") or []
    odd = [name for name, wrong in (
        ("model.type", model.get("type", "BPE") != "BPE"),
        ("pre_tokenizer", before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True)),
        ("normalizer", spec.get("normalizer") is not None),
        *((f"model.{key}", model.get(key)) for key in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")),
        *((f"added_tokens.{key}", any(t.get(key) for t in added)) for key in ("single_word", "lstrip", "rstrip")),
    ) if wrong]
    if odd:
        raise ValueError("prefix counts are exact for plain byte-level BPE files only; this one sets " + ", ".join(odd))


class PrefixCounter:
    """Prefix token counts for one tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        refuse_other_rules(spec)
        letters = byte_letters()
        to_bytes = lambda s: bytes(letters[c] for c in s)
        added = {t["content"] for t in spec.get("added_tokens", [])}
        self.vocab = {to_bytes(t) for t in spec["model"]["vocab"] if t not in added}
        self.rank = {}
        for i, m in enumerate(spec["model"]["merges"]):
            left, right = m if isinstance(m, list) else m.split(" ")
            self.rank[to_bytes(left), to_bytes(right)] = i
        self.made = {a + b: (a, b) for a, b in self.rank}
        if len(self.made) < len(self.rank):
            raise ValueError("two merges give the same token")
        self.pattern = regex.compile(PATTERN)
        self.latin = re.compile(LATIN_PATTERN)
        self.beyond = re.compile(r"[\u0250-\U0010ffff]")
        self.spaces = re.compile(r"\s{2}")
        self.only_spaces = regex.compile(r"\p{White_Space}+")
        self.added = regex.compile("|".join(regex.escape(t) for t in sorted(added, key=len, reverse=True))) if added else None
        self.rights: dict[bytes, list[tuple[bytes, int]]] = {}
        self.lefts: dict[bytes, list[tuple[bytes, int]]] = {}
        # tokens whose own bytes encode to something else never come out
        own = (t for t in self.vocab if len(t) == 1 or t in self.made and self._first_join(*self.made[t]) == self.made[t])
        self.tokens = sorted(own)
        self.number = {t: i for i, t in enumerate(self.tokens)}
        # whether two tokens stand side by side, by the pair of numbers as one integer
        self.apart: dict[int, bool] = {}
        # length of the longest token for each last pair of bytes: longer ends need not be tried
        self.reach: dict[bytes, int] = {}
        for token in self.tokens:
            self.reach[token[-2:]] = max(self.reach.get(token[-2:], 1), len(token))
        self.cache: dict[str, bytes] = {}
        self.cached = 0

    def _edge(self, token: bytes, side: int, known: dict[bytes, list[tuple[bytes, int]]]) -> list[tuple[bytes, int]]:
        """The parts that stand at one end of a token while it is merged, and the rank that ends each."""
        found = known.get(token)
        if found is None:
            parts, part, until = [], token, NEVER
            while True:
                parts.append((part, until))
                if part not in self.made:
                    break
                pair = self.made[part]
                until, part = self.rank[pair], pair[side]
            found = known[token] = parts[::-1]
        return found

    def _first_join(self, left: bytes, right: bytes) -> tuple[bytes, bytes] | None:
        """The first merge across the border of two tokens put side by side, if there is one.

        Merges run by rank, those of equal rank from the left, so the two sides grow independently
        until a pair across the border comes before the next merge of either side.
        """
        a, b = self._edge(left, 1, self.rights), self._edge(right, 0, self.lefts)
        i = j = 0
        while True:
            (x, x_until), (y, y_until) = a[i], b[j]
            across = self.rank.get((x, y), NEVER)
            if across < x_until and across <= y_until and across != NEVER:
                return x, y
            if x_until == y_until == NEVER:
                return None
            if x_until <= y_until:
                i += 1
            else:
                j += 1

    def _stands(self, left: int, right: int) -> bool:
        """Whether two tokens stay as they are side by side."""
        if len(self.apart) > MAX_PAIRS:
            self.apart.clear()
        known = self.apart[left << 32 | right] = self._first_join(self.tokens[left], self.tokens[right]) is None
        return known

    def piece_counts(self, piece: bytes) -> list[int]:
        """count[i] = tokens of piece[:i], for every i."""
        counts = [0] * (len(piece) + 1)
        last = [0] * (len(piece) + 1)
        number, apart, reach, two = self.number.get, self.apart.get, self.reach.get, b""
        for end in range(1, len(piece) + 1):
            two = piece[end - 2:end] if end > 1 else piece[:1]
            start = end - reach(two, 1)
            for start in range(start if start > 0 else 0, end):
                token = number(piece[start:end])
                if token is not None:
                    if start:
                        alone = apart(last[start] << 32 | token)
                        if not (self._stands(last[start], token) if alone is None else alone):
                            continue
                    counts[end] = counts[start] + 1
                    last[end] = token
                    break
        return counts

    def _changes(self, piece: str) -> bytes:
        """Change of the count at every byte of a piece (int8); bytes inside a character change nothing."""
        data = piece.encode()
        counts = self.piece_counts(data)
        if piece in ("'re", "'ve", "'ll"):  # cut short, the apostrophe and the letter are pieces of their own
            counts[2] = sum(self.piece_counts(m.encode())[-1] for m in self.pattern.findall(piece[:2]))
        if len(piece) != len(data):
            for i in range(1, len(data)):
                if data[i] & 0xC0 == 0x80:  # the byte before does not end a character
                    counts[i] = counts[i - 1]
        return bytes([(b - a) & 255 for a, b in zip(counts, counts[1:])])

    def _keep(self, piece: str) -> bytes:
        found = self._changes(piece)
        if len(self.cache) >= CACHE_PIECES or self.cached > CACHE_BYTES:
            self.cache.clear()
            self.cached = 0
        self.cache[piece] = found
        self.cached += len(found) + 100
        return found

    def _segment(self, text: str, out: list[bytes]) -> None:
        """Append the changes of a text without added tokens."""
        get, keep = self.cache.get, self._keep
        pieces = (self.pattern if self.beyond.search(text) else self.latin).findall(text)
        if not self.spaces.search(text):
            out += [get(p) or keep(p) for p in pieces]
            return
        owed, previous = 0, ""
        for piece in pieces:
            found = get(piece) or keep(piece)
            if owed:
                found, owed = self._shifted(piece, found, 0, owed), 0
            if previous and self.white(previous) and self.white(piece[0]):
                # up to here the prefix saw previous + piece[0] as one run of white space
                gap = (self.piece_counts((previous + piece[0]).encode())[-1]
                       - self.piece_counts(previous.encode())[-1] - self.piece_counts(piece[0].encode())[-1])
                found = self._shifted(piece, found, 0, gap)
                if len(piece) > 1:
                    found = self._shifted(piece, found, 1, -gap)
                else:
                    owed = -gap
            out.append(found)
            previous = piece

    def white(self, text: str) -> bool:
        return self.only_spaces.fullmatch(text) is not None

    @staticmethod
    def _shifted(piece: str, changes: bytes, char: int, by: int) -> bytes:
        """``changes`` with ``by`` added where the piece's character number ``char`` ends."""
        out = np.frombuffer(changes, np.int8).copy()
        out[len(piece[:char + 1].encode()) - 1] += by
        return out.tobytes()

    def changes(self, text: str) -> bytes:
        """The store of a text: change of its token count at every byte, as signed bytes."""
        out: list[bytes] = []
        if self.added is None or not self.added.search(text):
            self._segment(text, out)
            return b"".join(out)
        start = 0
        for found in self.added.finditer(text):
            self._segment(text[start:found.start()], out)
            out.append(self._added(text[start:found.start()], found.group()))
            start = found.end()
        self._segment(text[start:], out)
        return b"".join(out)

    def _added(self, before: str, token: str) -> bytes:
        """Until an added token is whole, its characters are ordinary text behind the last piece."""
        pieces = self.pattern.findall(before)
        # the last piece is the only one that more text can lengthen or cut
        tail = pieces[-1] if pieces else ""
        base = self.piece_counts(tail.encode())[-1]
        counts = [sum(self.piece_counts(m.encode())[-1] for m in self.pattern.findall(tail + token[:i]))
                  for i in range(1, len(token) + 1)]
        counts = [c - base for c in counts]
        counts[-1] = 1
        out = np.zeros(len(token.encode()), np.int8)
        ends = np.cumsum([len(c.encode()) for c in token]) - 1
        out[ends] = np.diff(counts, prepend=0)
        return out.tobytes()


def prefix_totals(store: bytes) -> np.ndarray:
    """Tokens of every byte prefix (1 byte, 2 bytes, ...)."""
    return np.cumsum(np.frombuffer(store, np.int8), dtype=np.int64)


def fitting_bytes(store: bytes, budget: int) -> int:
    """Length in bytes of the longest prefix with at most ``budget`` tokens."""
    fits = np.flatnonzero(prefix_totals(store) <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """The worker's counter for a tokenizer file, made once."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def _stores(path: str, with_store: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in batches:
            sizes, tokens, kept = [], [], []
            for text in batch.column(1):
                changes = count.changes(text.as_py() or "")
                sizes.append(len(changes))
                tokens.append(int(np.frombuffer(changes, np.int8).sum(dtype=np.int64)))
                if with_store:
                    kept.append(zlib.compress(changes, 1))
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())]
            names = ["__id", "n_bytes", "n_tokens"]
            if with_store:
                columns.append(pa.array(kept, pa.binary()))
                names.append("prefix_store")
            yield pa.RecordBatch.from_arrays(columns, names)
    return run


def prefix_counts(df: DataFrame, tokenizer: str, limit: int = 1024, with_store: bool = True,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit and, with ``with_store``, prefix_store (zlib of the changes)."""
    schema = "__id long, n_bytes long, n_tokens long" + (", prefix_store binary" if with_store else "")
    counted = (df.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__t"))
               .mapInArrow(_stores(tokenizer, with_store), schema))
    return counted.select(F.col("__id").alias("doc_id"), "n_bytes", "n_tokens",
                          (F.col("n_tokens") > limit).alias("over_limit"),
                          *(["prefix_store"] if with_store else []))
