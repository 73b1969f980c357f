"""SentencePiece encoding by a streaming Viterbi search, and decoding.

The search runs over the characters of a text and keeps a window no longer than the longest
piece, since no piece reaches further back. Every boundary keeps the backpointer of its best
path only:

* for a unigram model, the path whose pieces have the largest sum of scores;
* for a byte-pair model (whose scores are merge ranks, which must not be added up), the path
  that merging would give. A sequence of pieces is what merging gives exactly if each two
  neighbours are, so one backpointer per boundary passes that test and all others fall away.

Backpointers are kept until all paths that can still go on meet in one boundary; the ids
before it are final and leave. Memory is bounded by the distance between such meetings, not by
the length of the text. The ids are those of the library that made the model.

Where no piece of the vocabulary crosses (a space after another character, the control
characters that no longer piece contains, and most punctuation after a letter or digit), all
paths meet by themselves. The stretches between
such places recur, so their ids are worked out once and remembered, up to a bound.

The model file is read on the driver and broadcast: its pieces (checked against
``MAX_PIECES``), no text.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import pairwise
from pathlib import Path
from string import punctuation

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
MAX_PIECES = 1_000_000
#: Stretches, and half as many pairs, remembered in a task.
REMEMBERED = 800_000
#: A character without piece costs so much more than the worst piece.
UNKNOWN_PENALTY = 10.0


@dataclass(frozen=True)
class Vocabulary:
    """``ids``: piece to (id, score). ``raw``: what each id decodes to, as bytes."""

    ids: dict[str, tuple[int, float]]
    raw: list[bytes]
    byte_ids: list[int]
    unknown: int
    reach: int
    worst: float
    apart: str
    after: str
    spaces_first: bool
    merging: bool

    @cached_property
    def endings(self) -> list:
        """The pieces by their last characters: [next by character, piece or "", score]."""
        root: list = [{}, "", 0.0]
        for piece, (_, score) in self.ids.items():
            node = root
            for c in reversed(piece):
                node = node[0].setdefault(c, [{}, "", 0.0])
            node[1:] = [piece, score]
        return root

    @staticmethod
    def load(path: str = MODEL) -> Vocabulary:
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        described = sentencepiece_model_pb2.ModelProto()
        described.ParseFromString(Path(path).read_bytes())
        kinds = described.trainer_spec
        if kinds.model_type not in (kinds.UNIGRAM, kinds.BPE):
            raise ValueError("only unigram and byte-pair models are searched")
        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        if n > MAX_PIECES:
            raise ValueError(f"{n} pieces are too many to broadcast")
        ids, raw, byte_ids = {}, [], [0] * 256 if any(map(model.is_byte, range(n))) else []
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:-1], 16)
                byte_ids[value] = i
                raw.append(bytes([value]))
            elif model.is_control(i) or model.is_unused(i):
                raw.append(b"")
            elif model.is_unknown(i):
                raw.append(" ⁇ ".encode())
            else:
                ids[piece] = (i, model.get_score(i))
                raw.append(piece.replace(SPACE, " ").encode())
        long = [p for p in ids if len(p) > 1]
        beside = {pair for p in long for pair in pairwise(p)}
        return Vocabulary(
            ids,
            raw,
            byte_ids,
            model.unk_id(),
            max(map(len, ids)),
            min(s for _, s in ids.values()) - UNKNOWN_PENALTY,
            "".join(c for c in "\n\r\t" if not any(c in p for p in long)),
            "".join(c for c in punctuation if not any(b == c and a.isalnum() for a, b in beside)),
            not any(SPACE in p.lstrip(SPACE) for p in long),
            kinds.model_type == kinds.BPE,
        )


class Neighbours(dict):
    """Whether two pieces stay next to each other under merging, remembered up to a bound."""

    def __init__(self, vocab: Vocabulary):
        self.rank = {p: -s for p, (_, s) in vocab.ids.items() if len(p) > 1}
        self.halves: dict[str, tuple[str, str] | None] = {}

    def split(self, piece: str) -> tuple[str, str] | None:
        """The two parts whose merge made the piece; None if merging never makes it."""
        if piece not in self.halves:
            parts, last = list(piece), None
            while len(parts) > 1:
                ranks = [self.rank.get(a + b, np.inf) for a, b in pairwise(parts)]
                i = int(np.argmin(ranks))
                if ranks[i] == np.inf:
                    break
                last = (parts[i], parts[i + 1])
                parts[i : i + 2] = ["".join(last)]
            self.halves[piece] = last if len(parts) == 1 else None
        return self.halves[piece]

    def __missing__(self, pair: tuple[str, str]) -> bool:
        if len(self) >= REMEMBERED // 4:
            self.clear()
        value = self[pair] = self.stay(*pair)
        return value

    def stay(self, left: str, right: str) -> bool:
        """Undo merges, the latest first: a merge across the middle must not come before."""
        if len(right) > 1 and self.split(right) is None:
            return False
        limit = np.inf
        while left:
            if self.rank.get(left + right, np.inf) < limit:
                return False
            first = self.rank[left] if len(left) > 1 else -1
            second = self.rank[right] if len(right) > 1 else -1
            if first < 0 and second < 0:
                break
            if first > second:
                limit, left = first, self.split(left)[1]
            else:  # of equal merges the left one comes first, so one across the middle may not tie
                limit, right = np.nextafter(second, np.inf), self.split(right)[0]
        return True


class Search:
    """The search over one stretch, fed in parts; ids that are certain can be taken at any time.

    Of paths with equal scores the one whose last piece is longer wins, at every boundary.
    """

    def __init__(self, vocab: Vocabulary, stay: Neighbours):
        self.vocab, self.stay, self.endings = vocab, stay, vocab.endings
        self.text = ""  # what follows the last boundary that all paths meet in
        # of each boundary in it: the last piece of its best path ("": unknown), where that starts, the score
        self.last, self.start, self.best = [""], [0], [0.0]

    def feed(self, text: str) -> None:
        """Go on over more characters; no piece reaches further back than the longest."""
        self.text += text
        text, last, start = self.text, self.last, self.start
        if not self.vocab.merging:
            return self._feed_scores()
        root, stay = self.endings, self.stay
        for end in range(len(last), len(text) + 1):
            node, i = root, end
            while i:
                i -= 1
                node = node[0].get(text[i])
                if node is None:  # no piece ends like this, so no longer one does
                    i = 0
                    break
                piece = node[1]
                if piece and stay[last[i], piece]:
                    last.append(piece)
                    start.append(i)
                    break
            if len(last) == end:  # an unknown character merges with nothing
                last.append("")
                start.append(end - 1)

    def _feed_scores(self) -> None:
        text, best, worst = self.text, self.best, self.vocab.worst
        for end in range(len(best), len(text) + 1):
            node, i, top, choice = self.endings, end, best[end - 1] + worst, (end - 1, "")
            known = False
            while i:
                i -= 1
                node = node[0].get(text[i])
                if node is None:
                    break
                if node[1]:
                    score = best[i] + node[2]
                    # a character with a piece of its own is not unknown
                    known = known or i == end - 1
                    if score >= top or (known and not choice[1]):
                        top, choice = score, (i, node[1])
            best.append(top)
            self.start.append(choice[0])
            self.last.append(choice[1])

    def _path(self, stop: int) -> list[int]:
        found = []
        while stop > 0:
            start, piece = self.start[stop], self.last[stop]
            if piece:
                found.append(self.vocab.ids[piece][0])
            elif self.vocab.byte_ids:
                found.extend(self.vocab.byte_ids[b] for b in reversed(self.text[start:stop].encode("utf-8", "surrogatepass")))
            else:
                found.append(self.vocab.unknown)
            stop = start
        found.reverse()
        return found

    def certain(self) -> list[int]:
        """The ids up to the boundary in which all paths meet that can still go on; they leave."""
        end = len(self.text)
        live = set(range(max(0, end + 1 - self.vocab.reach), end + 1))
        while len(live) > 1:
            furthest = max(live)
            live.discard(furthest)
            live.add(self.start[furthest])
        meet = live.pop()
        found = self._path(meet)
        self.text = self.text[meet:]
        for kept in (self.last, self.start, self.best):
            del kept[:meet]
        self.start = [max(0, s - meet) for s in self.start]
        return found

    def rest(self) -> list[int]:
        return self._path(len(self.text))


def viterbi(text: str, vocab: Vocabulary, stay: Neighbours) -> Iterator[list[int]]:
    """Ids of a text of any length, in parts that leave as soon as they are certain."""
    search, step = Search(vocab, stay), 4 * vocab.reach
    for at in range(0, len(text), step):
        if at:
            yield search.certain()
        search.feed(text[at : at + step])
    yield search.rest()


class Encoder:
    """Encodes whole texts; remembers stretches that no piece crosses the ends of.

    Remembered stretches are kept in two halves; when the younger is full the older goes, so that
    frequent ones stay. They end with the task.
    """

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.stay = vocab, Neighbours(vocab)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.altered: set[str] = set()
        if vocab.spaces_first:
            apart, after = re.escape(vocab.apart), re.escape(vocab.after)
            plain = f"[^ {apart}{after}]*"
            # a stretch goes on over such punctuation only where it follows no letter or digit
            run = rf" *[^ {apart}]{plain}" + (rf"(?:(?<![^\W_])[{after}]{plain})*" if after else "")
            self.split = re.compile((f"[{apart}]|" if apart else "") + f"{run}| +").findall
        else:
            self.split = lambda text: [text]

    def _learn(self, wanted: set[str]) -> None:
        """Search each of these stretches once; their ids are kept as the bytes of 32-bit numbers."""
        fresh = wanted.difference(self.known)
        if len(self.known) + len(fresh) > REMEMBERED // 2:
            self.older, self.known, fresh = self.known, {}, wanted
        for text in fresh:
            ids = self.older.get(text)
            if ids is None:
                marked = text.replace(" ", SPACE)
                found = [i for part in viterbi(marked, self.vocab, self.stay) for i in part]
                ids = array("i", found).tobytes()
                if b"".join(map(self.vocab.raw.__getitem__, found)) != text.encode("utf-8", "surrogatepass"):
                    self.altered.add(text)
            self.known[text] = ids

    def encode_all(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[bool]]:
        """For each text its ids behind a leading space mark (none for NULL or an empty text), and
        whether decoding them gives the text again."""
        parts = [self.split(" " + t) if t else [] for t in texts]
        wanted = set().union(*parts)
        self._learn(wanted)
        ids = [np.frombuffer(b"".join(map(self.known.__getitem__, p)), np.int32) for p in parts]
        # decoding joins what the ids stand for, so a text comes back if each of its stretches does
        odd = self.altered.intersection(wanted) if self.altered else ()
        same = [
            not odd or odd.isdisjoint(p) or decode(i.tolist(), self.vocab) == (t or "")
            for p, i, t in zip(parts, ids, texts, strict=True)
        ]
        if len(self.altered) > REMEMBERED // 2:
            self.known, self.older, self.altered = {}, {}, set()
        return ids, same

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_all([text])[0][0]


def decode(ids: Iterable[int], vocab: Vocabulary) -> str:
    """The text of some ids, without the leading space; broken byte runs become U+FFFD."""
    text = b"".join(map(vocab.raw.__getitem__, ids)).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


def encode(docs: DataFrame, model: str = MODEL, key: str = "doc_id", check: bool = False) -> DataFrame:
    """One row per input row: key, ids, n_ids; with ``check`` also restored.

    ``restored`` says whether decoding the ids gives the text again, which fails only for
    texts that hold the space mark itself. NULL and empty texts have no ids. Only ``key`` and
    text are read; repeated rows are encoded alike; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model))
    rows = docs.select(F.col(key).alias(key), "text")
    kind = dict(rows.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                ids, same = encoder.encode_all(part.column(1).to_pylist())
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
                columns = [part.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array(np.diff(ends))]
                if check:
                    columns.append(pa.array(same, pa.bool_()))
                yield pa.RecordBatch.from_arrays(columns, [key, "ids", "n_ids", "restored"][: len(columns)])

    return rows.mapInArrow(run, f"`{key}` {kind}, ids array<int>, n_ids int" + (", restored boolean" if check else ""))


def decoded(rows: DataFrame, model: str = MODEL, key: str = "doc_id") -> DataFrame:
    """One row per input row: key, text, from a column ids; NULL ids give NULL."""
    shared = rows.sparkSession.sparkContext.broadcast(Vocabulary.load(model))
    kind = dict(rows.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if i is None else decode(i, shared.value) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [key, "text"])

    return rows.select(F.col(key).alias(key), "ids").mapInArrow(run, f"`{key}` {kind}, text string")
