"""SentencePiece BPE encoding and decoding by backtracking.

Encoding. A text becomes ``▁`` + text with spaces as ``▁`` and is cut into
segments that no piece of the vocabulary can span (before each run of ``▁``,
between punctuation and letters if no piece holds both, and around characters
without a piece, which become byte pieces). Within a segment

* one Aho-Corasick pass lists every piece that starts at each position,
* the longest one is tried first; it may follow the piece before it only if
  merging the two pieces' characters again gives just these two,
* a position from which no piece fits is cleared in a bit field and never tried
  again, and the search goes back by one piece.

The result is the merge order's own segmentation. The equivalence needs distinct
merge priorities: segments with a piece whose score others share (runs of spaces
in the public model) are merged directly, highest score and leftmost first.

Segments are memoised per worker in two generations of bounded size, so each
distinct word is solved about once per task.
"""

from __future__ import annotations

import hashlib
import re
import string
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .scratch import ship

META = "▁"
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class PieceCodec:
    """Encoder and decoder of one BPE model file with byte fallback; ``memo`` bounds each cache generation, which a worker keeps as long as it lives."""

    def __init__(self, model_file: str, memo: int = 100_000):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(size)]
        self.bytes = {i: int(self.pieces[i][3:5], 16) for i in range(size) if sp.IsByte(i)}
        self.byte_id = {b: i for i, b in self.bytes.items()}
        self.silent = {i for i in range(size) if sp.IsControl(i)}
        normal = [i for i in range(size) if not (sp.IsByte(i) or sp.IsControl(i) or sp.IsUnknown(i) or sp.IsUnused(i))]
        self.id_of = {self.pieces[i]: i for i in normal}
        self.plain_ids = set(normal)
        self.score = {self.pieces[i]: sp.GetScore(i) for i in normal}
        if len(self.byte_id) != 256:
            raise ValueError("the model has no byte pieces for characters outside its vocabulary")
        # A piece of one character is where merging begins; its score is never used.
        shared = Counter(s for p, s in self.score.items() if len(p) > 1)
        self.tied = [p for p, s in self.score.items() if len(p) > 1 and shared[s] > 1]
        self.chars = {p for p in self.id_of if len(p) == 1}
        self.automaton = ahocorasick.Automaton()
        for p in self.id_of:
            self.automaton.add_word(p, len(p))
        self.automaton.make_automaton()
        self.crosses = [p for p in self.id_of if META in p.lstrip(META) or "\n" in p]
        self.memo = memo
        self.young: dict[str, tuple[str, str]] = {}
        self.old: dict[str, tuple[str, str]] = {}
        self.follows: dict[tuple[str, str], bool] = {}
        self.segments = lambda s: [s] if s else []
        if not self.crosses:
            signs = self.signs()
            inner = f" *[{signs}]+| *[^ \n{signs}]+" if signs else r" *[^ \n]+"
            self.segments = re.compile(rf"\n|{inner}| +").findall
        self.tie = re.compile("|".join(map(re.escape, sorted(self.tied, key=len)))) if self.tied else None

    def signs(self) -> str:
        """Regex class of the punctuation that shares no piece with other characters; empty if there is none.

        The closure of the ASCII punctuation under sharing a piece, so no piece holds characters of both sides.
        """
        signs = set(string.punctuation)
        bodies = [set(p.lstrip(META)) for p in self.id_of if len(p.lstrip(META)) > 1]
        while grown := {c for b in bodies if signs & b for c in b} - signs:
            signs |= grown
        return "" if signs & set(META + " \n") else "".join(map(re.escape, sorted(signs)))

    def merged(self, chars: list[str]) -> list[str]:
        """Merge neighbours, highest score first and leftmost among equals, until no piece is formed.

        Possible merges wait in a heap, so a run of n characters takes about n log n steps.
        """
        parts: list[str] = list(chars)
        score, n = self.score, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        waiting = [(-score[p], i, p) for i in range(n - 1) if (p := parts[i] + parts[i + 1]) in score]
        heapify(waiting)
        while waiting:
            _, i, piece = heappop(waiting)
            j = after[i]
            # a neighbour that has been merged since is no part of this one any more
            if not parts[i] or j >= n or parts[i] + parts[j] != piece:
                continue
            parts[i], parts[j] = piece, ""
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (p := parts[left] + parts[right]) in score:
                    heappush(waiting, (-score[p], left, p))
        return [p for p in parts if p]

    def compatible(self, a: str, b: str) -> bool:
        """Whether merging the characters of both pieces gives these two pieces again."""
        found = self.follows.get((a, b))
        if found is None:
            if len(self.follows) >= 4 * self.memo:
                self.follows.clear()
            found = self.follows[a, b] = self.merged(list(a + b)) == [a, b]
        return found

    def shorter(self, piece: str) -> str:
        """The next shorter piece that begins this one, or nothing."""
        for k in range(len(piece) - 1, 0, -1):
            if piece[:k] in self.id_of:
                return piece[:k]
        return ""

    def backtrack(self, text: str) -> list[str]:
        """Pieces of a text whose every character is a piece."""
        follows, iter_long = self.follows, self.automaton.iter_long
        ahead = iter_long(text)  # the longest match at each step, while the search has not left that path
        at, n, failed, taken, last = 0, len(text), 0, [], ""
        while at < n:
            piece = text[at : next(ahead)[0] + 1]
            while True:
                if not failed >> at + len(piece) & 1 and (not last or (follows[last, piece] if (last, piece) in follows else self.compatible(last, piece))):
                    taken.append(piece)
                    at += len(piece)
                    last = piece
                    break
                ahead = None
                piece = self.shorter(piece)
                while not piece:
                    if not taken:
                        raise ValueError("no valid segmentation")
                    failed |= 1 << at
                    at -= len(last)
                    piece = self.shorter(taken.pop())
                    last = taken[-1] if taken else ""
            if ahead is None and at < n:
                ahead = iter_long(text, at)
        return taken

    def solve(self, segment: str) -> list[int]:
        """Ids of one segment (``▁`` already in place)."""
        if self.chars.issuperset(segment) and not (self.tie and self.tie.search(segment)):
            return [self.id_of[p] for p in self.backtrack(segment)]
        ids: list[int] = []
        run: list[str] = []

        def flush() -> None:
            if run:
                part = "".join(run)
                found = self.merged(run) if self.tie and self.tie.search(part) else self.backtrack(part)
                ids.extend(self.id_of[p] for p in found)
                run.clear()

        for c in segment:
            if c in self.id_of:
                run.append(c)
            else:
                flush()
                ids.extend(self.byte_id[b] for b in c.encode())
        flush()
        return ids

    def entry(self, segment: str) -> tuple[str, str]:
        """Joined ids and decoded text of a segment, through the two cache generations."""
        found = self.young.get(segment)
        if found is None:
            found = self.old.get(segment)
            if found is None:
                ids = self.solve(segment.replace(" ", META))
                found = (",".join(map(str, ids)), self.decode_inner(ids))
            if len(self.young) >= self.memo:
                self.old, self.young = self.young, {}
            if len(segment) <= 64:
                self.young[segment] = found
        return found

    def decode_inner(self, ids: list[int]) -> str:
        if self.plain_ids.issuperset(ids):
            return "".join([self.pieces[i] for i in ids]).replace(META, " ")
        out, raw = [], bytearray()
        for i in ids:
            if i in self.bytes:
                raw.append(self.bytes[i])
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            if i not in self.silent:
                out.append(self.pieces[i].replace(META, " "))
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        return "".join(out)

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text."""
        joined = self.joined(text)[0]
        return [int(i) for i in joined.split(",")] if joined else []

    def decode(self, ids: list[int]) -> str:
        """Text of a list of ids: pieces joined, byte pieces as UTF-8, without the space put before the text."""
        return self.decode_inner(ids).removeprefix(" ")

    def joined(self, text: str) -> tuple[str, str]:
        """Comma-joined ids of a whole text, and the text decoded from them."""
        if not text:
            return "", ""
        found = [self.young.get(s) or self.entry(s) for s in self.segments(" " + text.replace(META, " "))]
        return ",".join([f[0] for f in found]), "".join([f[1] for f in found]).removeprefix(" ")


@lru_cache(maxsize=2)
def codec(model_file: str) -> PieceCodec:
    """The worker's codec of a model file (loaded once per Python worker)."""
    return PieceCodec(model_file)


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "replace")).hexdigest()


def encode_documents(docs: DataFrame, model_file: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row's whole text.

    ``model_file`` is a path that every executor has (the installed public
    tokenizer package by default). Null or empty text: 0 tokens, digests of the
    empty string. A null doc_id is kept; repeated rows each give a row; an empty
    table gives an empty result; other columns are not read.
    """
    def tokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        c = codec(model_file or public_tokenizers.path("piece_bpe_32k.model"))
        for batch in batches:
            counts, ids, decoded = [], [], []
            for text in batch.column("text"):
                joined, back = c.joined(text.as_py() or "")
                counts.append(joined.count(",") + 1 if joined else 0)
                ids.append(hashlib.sha256(joined.encode()).hexdigest())
                decoded.append(_digest(back))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    ship(docs.sparkSession)
    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(tokenised, SCHEMA)
