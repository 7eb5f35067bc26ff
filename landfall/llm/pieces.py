"""Encoding of texts into vocabulary pieces, and back.

The pieces of a SentencePiece model lie in an Aho-Corasick automaton. A text runs
through it once; at each character the node and its output links name every piece
that ends there, longest first, and each relaxes the best score of that position
from the position where it starts. Equal scores keep the longer last piece. A
character that is no piece of its own falls back to the pieces of its UTF-8 bytes,
at a score below that of any piece.

No piece holds a blank behind another character, and some characters stand in no
piece at all or in none behind a letter, so the best path of a text is the best
paths of its words in a row, and a word met before needs no second run. A blank
precedes every text, as the model has it; decoding takes it away, so that any text
comes back exactly, blanks and the blank's sign in the vocabulary included.

Edge cases: a NULL text is an empty one and has no pieces. A NULL id is kept.
Repeated rows get equal results, an empty table an empty one. Texts are encoded
whole, whatever their length. Other columns are never looked at.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SIGN = "▁"  # how the vocabulary writes a blank
# Letters, as far as a pattern can tell them.
LETTER = r"[^\W\d_²³¹]"
# What a worker remembers: segments, and the longest of them.
REMEMBERED, LONGEST = 100_000, 48
# Segments worked out at once, and characters of text split at once.
SIDE_BY_SIDE, CHARACTERS = 20_000, 250_000


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with blanks written out, their scores and ids, and the ids of the 256 bytes."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    ids: tuple[int, ...]
    bytes_: tuple[int, ...]

    def __post_init__(self) -> None:
        if any(" " in piece.lstrip(" ") for piece in self.pieces):
            raise ValueError("a piece holds a blank behind another character")


def load_vocabulary(path: str = MODEL) -> Vocabulary:
    """Read a model's pieces; control, unused and unknown pieces take no part."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    every = range(model.vocab_size())
    plain = [
        i
        for i in every
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    bytes_ = tuple(i for i in every if model.is_byte(i))
    if len(bytes_) != 256:
        raise ValueError("the model has no pieces for bytes")
    return Vocabulary(
        tuple(model.id_to_piece(i).replace(SIGN, " ") for i in plain),
        tuple(model.get_score(i) for i in plain),
        tuple(plain),
        bytes_,
    )


def segment_pattern(pieces: tuple[str, ...]) -> re.Pattern:
    """Cuts a text where no piece can reach across."""
    held = "".join(pieces)
    apart = "".join(re.escape(c) for c in "\t\n\r\x0b\x0c" if c not in held) or "\x00"
    if "\x00" in held:
        raise ValueError("a piece holds a zero character")
    behind = {p[at + 1] for p in pieces for at in range(len(p) - 1) if re.match(LETTER, p[at])}
    marks = [c for c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" if c not in behind]
    ahead = f"(?=[{''.join(map(re.escape, marks))}])" if marks else "(?!)"
    return re.compile(rf" *{LETTER}++{ahead}| *[^ {apart}]+| +|[{apart}]")


@dataclass
class Runs:
    """Runs of numbers in one array: where each starts, and its length."""

    flat: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray

    @staticmethod
    def of(runs: list[np.ndarray], kind: type) -> Runs:
        empty = np.zeros(0, np.int64)
        all_ = Runs(np.zeros(0, kind), empty, empty)
        all_.add(np.concatenate([empty, *runs]), np.array([len(r) for r in runs], np.int64))
        return all_

    def add(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        starts = len(self.flat) + np.cumsum(lengths) - lengths
        self.flat = np.concatenate((self.flat, flat.astype(self.flat.dtype)))
        self.starts = np.concatenate((self.starts, starts))
        self.lengths = np.concatenate((self.lengths, lengths))

    def take(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The chosen runs in a row, and their lengths."""
        lengths = self.lengths[which]
        before = np.cumsum(lengths) - lengths
        at = np.repeat(self.starts[which] - before, lengths)
        return self.flat[at + np.arange(len(at))], lengths


@dataclass
class Encoder:
    """The automaton: `step` by node, `fail` links, and `out`: the pieces that end at a node."""

    vocabulary: Vocabulary
    step: list[dict[str, int]] = field(default_factory=lambda: [{}])
    fail: list[int] = field(default_factory=lambda: [0])
    own: list[tuple[int, float, int] | None] = field(default_factory=lambda: [None])
    output: list[int] = field(default_factory=lambda: [0])
    linked: dict[int, tuple] = field(default_factory=dict)
    seen: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        v = self.vocabulary
        for piece, score, id_ in zip(v.pieces, v.scores, v.ids, strict=True):
            node = 0
            for char in piece:
                if char not in self.step[node]:
                    self.step[node][char] = len(self.step)
                    self.step.append({})
                    self.fail.append(0)
                    self.own.append(None)
                    self.output.append(0)
                node = self.step[node][char]
            self.own[node] = (len(piece), score, id_)
        todo = deque(self.step[0].values())
        while todo:
            node = todo.popleft()
            # the nearest suffix that is a piece
            suffix = self.fail[node]
            self.output[node] = suffix if self.own[suffix] else self.output[suffix]
            for char, child in self.step[node].items():
                back = self.fail[node]
                while back and char not in self.step[back]:
                    back = self.fail[back]
                self.fail[child] = self.step[back].get(char, 0)
                todo.append(child)
        edges = [(n << 21 | ord(c), to) for n, step in enumerate(self.step) for c, to in step.items()]
        self.edges, self.targets = np.array(sorted(edges), np.int64).reshape(-1, 2).T.copy()
        self.fails, self.outputs = np.array(self.fail), np.array(self.output)
        ends = np.array([piece or (0, 0.0, -1) for piece in self.own])
        self.sizes, self.scores, self.names = ends[:, 0].astype(int), ends[:, 1], ends[:, 2].astype(int)
        self.segments = segment_pattern(v.pieces).findall
        self.fallback = min((s for s in v.scores if s > -1e8), default=0.0) - 10
        spelled = [b""] * (max((*v.ids, *v.bytes_)) + 1)
        for piece, id_ in zip(v.pieces, v.ids, strict=True):
            spelled[id_] = piece.encode()
        for byte, id_ in enumerate(v.bytes_):
            spelled[id_] = bytes([byte])
        self.spelled = Runs.of([np.frombuffer(x, np.uint8) for x in spelled], np.uint8)
        self.forget()

    def forget(self) -> None:
        """Drop all remembered segments: `seen` has their places in `paths`, `totals` and `met`, in order."""
        self.seen.clear()
        self.paths = Runs.of([], np.int32)
        self.totals = np.zeros(0)
        self.met = np.zeros(0, np.int32)

    def forget_rare(self) -> None:
        """Keep the segments that were met again most often, half as many as may be remembered."""
        most = REMEMBERED // 2
        kept = np.argsort(-self.met, kind="stable")[:most]
        kept = np.sort(kept[self.met[kept] > 0])
        flat, lengths = self.paths.take(kept)
        if len(flat) > 8 * most:
            kept, flat, lengths = kept[:0], flat[:0], lengths[:0]
        held = np.zeros(len(self.seen), bool)
        held[kept] = True
        words = [word for word, stays in zip(self.seen, held.tolist(), strict=True) if stays]
        totals, met = self.totals[kept], self.met[kept] // 2
        self.forget()
        self._remember(words, flat, lengths, totals)
        self.met = met

    def ends_at(self, node: int) -> tuple[tuple[int, float, int], ...]:
        """The pieces that end at a node, by its output links: longest first."""
        found = self.linked.get(node)
        if found is None:
            links, link = [], node if self.own[node] else self.output[node]
            while link:
                links.append(self.own[link])
                link = self.output[link]
            found = self.linked[node] = tuple(links)
        return found

    def best_path(self, text: str) -> tuple[tuple[int, ...], float]:
        """Ids and score of the best path through a text, in one pass."""
        step, fail, linked = self.step, self.fail, self.linked
        low, fallback = float("-inf"), self.fallback
        score = [0.0]
        sizes, chosen = [0], [0]
        node = at = 0
        for char in text:
            while node and char not in step[node]:
                node = fail[node]
            node = step[node].get(char, 0)
            at += 1
            best, size = low, 0
            for piece in linked[node] if node in linked else self.ends_at(node):
                size, worth, id_ = piece
                worth += score[at - size]
                if worth > best:
                    best, via, last = worth, size, id_
            if size != 1 and score[-1] + fallback > best:  # the character is no piece of its own
                best, via, last = score[-1] + fallback, 1, -1
            score.append(best)
            sizes.append(via)
            chosen.append(last)
        ids: list[int] = []
        while at:
            if chosen[at] < 0:
                raw = text[at - 1 : at].encode()
                ids.extend(self.vocabulary.bytes_[b] for b in reversed(raw))
            else:
                ids.append(chosen[at])
            at -= sizes[at]
        return tuple(reversed(ids)), score[-1]

    def best_paths(self, words: list[str]) -> None:
        """`best_path` of many short words side by side, remembered; all stand at one position.

        Words are in order of falling length, so that those which go on stand in front.
        """
        words = sorted(words, key=len, reverse=True)
        lengths = np.fromiter(map(len, words), int, len(words))
        starts = np.cumsum(lengths) - lengths
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        longest = lengths[0]
        score = np.zeros((longest + 1, len(words)))
        size = np.zeros((longest + 1, len(words)), np.int8)
        name = np.zeros((longest + 1, len(words)), np.int32)
        nodes = np.zeros(len(words), np.int64)
        for at in range(1, longest + 1):
            going = int(np.searchsorted(-lengths, -at, "right"))
            char, node = chars[starts[:going] + at - 1], nodes[:going]
            todo = np.arange(going)
            while len(todo):  # failure links, until the character leads on or the root is reached
                edge = node[todo] << 21 | char[todo]
                place = np.minimum(np.searchsorted(self.edges, edge), len(self.edges) - 1)
                hit = self.edges[place] == edge
                root = node[todo] == 0
                node[todo] = np.where(hit, self.targets[place], self.fails[node[todo]])
                todo = todo[~hit & ~root]
            best, via = np.full(going, -np.inf), np.zeros(going, np.int8)
            last = np.full(going, -1, np.int32)
            link = np.where(self.sizes[node] > 0, node, self.outputs[node])
            single = np.zeros(going, bool)
            todo = np.flatnonzero(link)
            while len(todo):  # output links, from the longest piece to the shortest
                piece = link[todo]
                sizes = self.sizes[piece]
                worth = score[at - sizes, todo] + self.scores[piece]
                better = worth > best[todo]
                chosen = todo[better]
                best[chosen], via[chosen] = worth[better], sizes[better]
                last[chosen] = self.names[piece[better]]
                single[todo] = sizes == 1
                link[todo] = self.outputs[piece]
                todo = todo[link[todo] > 0]
            worth = score[at - 1, :going] + self.fallback
            alone = ~single & (worth > best)  # the character is no piece of its own
            score[at, :going] = np.where(alone, worth, best)
            size[at, :going] = np.where(alone, 1, via)
            name[at, :going] = np.where(alone, -1, last)
        back, rows, steps, found = lengths.copy(), np.arange(len(words)), [], []
        counts = np.zeros(len(words), np.int64)
        while len(rows):  # from the ends back to the starts
            via = back[rows]
            id_ = name[via, rows].astype(np.int64)
            alone = id_ < 0
            id_[alone] = -1 - chars[starts[rows[alone]] + via[alone] - 1]
            steps.append(rows)
            found.append(id_)
            counts[rows] += 1
            back[rows] = via - size[via, rows]
            rows = rows[back[rows] > 0]
        row = np.concatenate(steps)
        step = np.repeat(np.arange(len(steps)), list(map(len, steps)))
        order = np.lexsort((-step, row))
        self._remember(words, np.concatenate(found)[order], counts, score[lengths, np.arange(len(words))])

    def _remember(self, words: list[str], ids: np.ndarray, counts: np.ndarray, totals: np.ndarray) -> None:
        """Keep paths; a negative id is a character that its bytes stand for."""
        if (ids < 0).any():
            row = np.repeat(np.arange(len(words)), counts)
            each = [
                [i] if i >= 0 else [self.vocabulary.bytes_[b] for b in chr(-1 - i).encode()]
                for i in ids.tolist()
            ]
            counts = np.bincount(row, list(map(len, each)), len(words)).astype(np.int64)
            ids = np.fromiter((i for part in each for i in part), np.int64)
        first = len(self.seen)
        self.seen.update(zip(words, range(first, first + len(words)), strict=True))
        self.paths.add(ids, counts)
        self.totals = np.concatenate((self.totals, totals))
        self.met = np.concatenate((self.met, np.zeros(len(words), np.int32)))

    def meet(self, segments: set[str]) -> None:
        """Work out the segments that are not remembered; forget rare ones if those are too many."""
        if len(self.seen) > REMEMBERED or len(self.paths.flat) > 8 * REMEMBERED:
            self.forget_rare()
        new = [s for s in segments if s not in self.seen]
        again = (self.seen[s] for s in segments if s in self.seen)
        self.met[np.fromiter(again, np.int64, len(segments) - len(new))] += 1
        short = [s for s in new if len(s) <= LONGEST]
        for first in range(0, len(short), SIDE_BY_SIDE):
            self.best_paths(short[first : first + SIDE_BY_SIDE])
        for segment in new:
            if len(segment) > LONGEST:
                ids, total = self.best_path(segment)
                self._remember([segment], np.array(ids), np.array([len(ids)]), np.array([total]))

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts in a row, how many each has, and each one's score."""
        split = [self.segments(" " + text) if text else [] for text in texts]
        self.meet({segment for segments in split for segment in segments})
        words = np.fromiter(map(len, split), np.int64, len(split))
        places = np.fromiter(
            (self.seen[segment] for segments in split for segment in segments), np.int64, words.sum()
        )
        of = np.repeat(np.arange(len(texts)), words)
        ids, counts = self.paths.take(places)
        totals = np.bincount(of, self.totals[places], len(texts))
        return ids, np.bincount(of, counts, len(texts)).astype(np.int64), totals

    def decode_all(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The texts that runs of ids stand for, as UTF-8."""
        raw, sizes = self.spelled.take(ids)
        ends = np.cumsum(sizes)[np.cumsum(counts) - 1] if len(ids) else counts
        raw, out, at = raw.tobytes(), [], 0
        for count, end in zip(counts.tolist(), ends.tolist(), strict=True):
            out.append(raw[at + 1 : end] if count else b"")  # without the blank in front
            at = end if count else at
        return out

    def encode(self, text: str) -> tuple[tuple[int, ...], float]:
        """Ids and score of a text."""
        ids, _, totals = self.encode_all([text])
        return tuple(ids.tolist()), float(totals[0])

    def decode(self, ids: tuple[int, ...]) -> str:
        return self.decode_all(np.array(ids, np.int64), np.array([len(ids)]))[0].decode()


_ENCODERS: dict[Vocabulary, Encoder] = {}


def encoder_of(vocabulary: Vocabulary) -> Encoder:
    """The automaton of a vocabulary, built once in each worker."""
    if vocabulary not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[vocabulary] = Encoder(vocabulary)
    return _ENCODERS[vocabulary]


def in_parts(texts: pa.Array) -> Iterator[list[str]]:
    """The texts in parts of some `CHARACTERS`, or of a single text."""
    part, size = [], 0
    for x in texts:
        body = x.as_py()
        if part and size + len(body) > CHARACTERS:
            yield part
            part, size = [], 0
        part.append(body)
        size += len(body)
    if part:
        yield part


ENCODED = "ids array<int>, n_pieces long, score double, exact boolean"


def encoded(vocabulary: Vocabulary, text: str = "text") -> Column:
    """A struct: ids, how many, their score, and whether they decode to the very text."""

    @F.arrow_udf(returnType=ENCODED)
    def encode(texts: pa.Array) -> pa.Array:
        encoder = encoder_of(vocabulary)
        values, counts, scores, exact = [], [], [], []
        for bodies in in_parts(texts):
            ids, n, totals = encoder.encode_all(bodies)
            values.append(ids)
            counts.append(n)
            scores.append(totals)
            again = encoder.decode_all(ids, n)
            exact += [a == b.encode() for a, b in zip(again, bodies, strict=True)]
        n = np.concatenate([np.zeros(0, np.int64), *counts])
        ends = pa.array(np.concatenate(([0], np.cumsum(n))).astype(np.int32))
        ids = np.concatenate([np.zeros(0, np.int32), *values])
        columns = [
            pa.ListArray.from_arrays(ends, pa.array(ids)),
            pa.array(n),
            pa.array(np.concatenate([np.zeros(0), *scores])),
            pa.array(exact, pa.bool_()),
        ]
        return pa.StructArray.from_arrays(columns, ["ids", "n_pieces", "score", "exact"])

    return encode(text_of(text))


def decoded(vocabulary: Vocabulary, ids: str = "ids") -> Column:
    """The texts that arrays of ids stand for; NULL stays NULL."""

    @F.arrow_udf(returnType="string")
    def decode(lists: pa.Array) -> pa.Array:
        encoder = encoder_of(vocabulary)
        return pa.array(
            [None if (ids := x.as_py()) is None else encoder.decode(ids) for x in lists],
            pa.string(),
        )

    return decode(F.col(ids))


def encode_documents(documents: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """`doc_id` and the pieces of every document."""
    return documents.select("doc_id", encoded(vocabulary).alias("e")).select("doc_id", "e.*")
