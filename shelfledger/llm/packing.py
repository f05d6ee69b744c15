"""Packing documents into token sequences by order-preserving dynamic programming.

Documents are laid on end in the order they are stored in. The line of tokens is cut into
windows of at most WIDTH tokens; cuts are possible at the ends of documents, lines and sentences
and, in long sentences, every LONGEST tokens at a higher price. The cuts that minimise padding plus a penalty
for cutting documents come from one pass over the candidates: the best earlier cut is the head
of a monotone queue, because a window's padding is linear in where it begins. Windows whose
length is a power of two need no padding and are looked up beside it.

Each partition is packed for itself in one pass, so there is no shuffle and no hot key; what it
costs is one unfilled sequence per partition. Cuts are given out as soon as what follows can't
change them, so they are the cheapest of the whole partition; until then a worker keeps the ids
(measured: up to a million, 4 MB; at worst those of the partition).
"""

from __future__ import annotations

import json
import os
import re
from bisect import bisect_left
from collections import deque
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from shelfledger.llm.batches import IS_BLANK, runs_of, slices, small_batches, text_bytes
from shelfledger.llm.common import documents

#: Tokens of a sequence.
WIDTH = 2048
#: Id that ends a document.
END_ID = 1
#: Costs in tokens of padding: per window, and for a cut at each kind of place.
PER_WINDOW = 2.0
AT_LINE, AT_SENTENCE, ANYWHERE = 1.0, 2.0, 8.0
#: A stretch without a place to cut gets one every so many tokens.
LONGEST = 32
#: Lengths without padding that are looked for.
POWERS = (256, 512, 1024, 2048)
#: Words whose ids a worker remembers.
REMEMBERED = 1_000_000


#: How the tokenizers that ``Tokens`` has a short way for part a text, and what
#: they put behind the last letter of a piece.
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_LAST = "</w>"
#: The same for lower-case words of ASCII and Latin letters, which _LATIN tells from others.
_LATIN_SPLIT = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^a-zß-öø-ſ0-9\n]+"
)
_LATIN = re.compile("[!-~À-ÖØ-öø-įıĲ-ſ]+")
#: Stands for _LAST in bytes; no word of _LATIN holds it.
_MARK = "\x01"


def _byte_letters() -> list[str]:
    """Byte-level tokenizers write a byte as a letter: a printable one as itself, the others
    in turn from 256 on."""
    itself = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in itself else chr(next(others)) for b in range(256)]


class LatinMerges:
    """The merges of a tokenizer on many words at once.

    A piece of a word is its bytes and _MARK. The first merges join a byte and the mark, the
    others come in the order of the file, so the merging of equal bytes is that of the tokenizer:
    what two symbols make is made of no other two (tested for the whole vocabulary).
    """

    def __init__(self, vocab: dict[str, int], merges: list):
        import tiktoken

        letters = _byte_letters()
        code = {c: b for b, c in enumerate(letters)}
        made = [(c, bytes([b])) for b, c in enumerate(letters)]
        made += [(c + _LAST, bytes([b]) + _MARK.encode()) for b, c in enumerate(letters)]
        for pair in merges:
            token = "".join(pair if isinstance(pair, list) else pair.split(" "))
            last = token.endswith(_LAST)
            text = bytes(code[c] for c in (token.removesuffix(_LAST) if last else token))
            made.append((token, text + (_MARK.encode() if last else b"")))
        self.id = np.array([vocab[token] for token, _ in made], dtype="<u4")
        self.size = np.array([len(text) for _, text in made])
        self.coder = tiktoken.Encoding(
            "words", pat_str=f"[^{_MARK}\n]+{_MARK}",
            mergeable_ranks={text: rank for rank, (_, text) in enumerate(made)}, special_tokens={},
        )
        if len(self.coder._mergeable_ranks) != len(made):
            raise ValueError("two merges make the same symbol")

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words on end, and how many each has."""
        text = _LATIN_SPLIT.sub(r"\g<0>" + _MARK, "\n".join(words).lower())
        ranks = np.array(self.coder.encode_ordinary(text), dtype=np.int64)
        line_ends = np.flatnonzero(np.frombuffer(text.encode() + b"\n", dtype=np.uint8) == 10)
        letters = line_ends - np.arange(len(words))  # up to the end of each word
        ends = np.searchsorted(np.cumsum(self.size[ranks]), letters, side="right")
        return self.id[ranks], np.diff(ends, prepend=0)


class Tokens:
    """Ids of texts word by word: the tokenizer never joins what blanks separate, so a word's
    ids are the same in any text, and are remembered.

    Where the tokenizer parts text as _SPLIT says, lower-cased and by bytes, words of Latin
    letters go to its merges at once. Other words, and all words of other tokenizers, go through
    the tokenizer as they are.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.forget()
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        model = stated["model"]
        steps = [n["type"] for n in (stated["normalizer"] or {}).get("normalizers", [])]
        parts = (stated["pre_tokenizer"] or {}).get("pretokenizers", [])
        by_merges = (
            steps == ["NFC", "Replace", "Lowercase"] and len(parts) == 2
            and parts[0].get("pattern") == {"Regex": _SPLIT} and parts[0].get("invert") is True
            and parts[1]["type"] == "ByteLevel" and not parts[1]["use_regex"]
            and not parts[1]["add_prefix_space"]
            and model["type"] == "BPE" and model["end_of_word_suffix"] == _LAST
            and not model["ignore_merges"] and not model["dropout"]
        )
        self.latin = LatinMerges(model["vocab"], model["merges"]) if by_merges else None
        special = "|".join(re.escape(t["content"]) for t in stated["added_tokens"])
        self.special = re.compile(special or "(?!)")

    @classmethod
    def shared(cls, path: str) -> Tokens:
        """The one of this worker process, with the words it has learnt in other tasks. It is
        kept at a module that is imported, since this one travels with each task."""
        import tokenizers

        kept = tokenizers.__dict__.setdefault("_tokens_of_words", {})
        if path not in kept:
            kept[path] = cls(path)
        return kept[path]

    def forget(self) -> None:
        #: Words by their number, and the ids of word n: those from starts[n] to starts[n + 1].
        self.known: dict[str, int] = {}
        self.ids, self.starts = np.zeros(0, dtype="<u4"), np.zeros(1, dtype=np.int64)

    def _learn(self, words: list[str]) -> None:
        latin, others = [], words
        if self.latin is not None:
            plain, special = _LATIN.fullmatch, self.special.search
            latin = [w for w in words if plain(w) and not ("<" in w and special(w))]
            if len(latin) < len(words):
                taken = set(latin)
                others = [w for w in words if w not in taken]
            else:
                others = []
        ids, sizes = [self.ids], []
        if latin:
            found, n = self.latin(latin)
            ids.append(found)
            sizes.append(n)
        for at in range(0, len(others), 20_000):
            coded = self.tokenizer.encode_batch_fast(
                others[at:at + 20_000], add_special_tokens=False
            )
            ids += [np.array(c.ids, dtype="<u4") for c in coded]
            sizes.append(np.array([len(c) for c in coded]))
        first = len(self.known)
        self.known.update(zip([*latin, *others], range(first, first + len(words)), strict=True))
        self.ids = np.concatenate(ids)
        self.starts = np.concatenate(
            [self.starts, self.starts[-1] + np.cumsum(np.concatenate(sizes))])

    def numbers(self, words: list[str]) -> np.ndarray:
        """The number of each of some distinct words; new ones are learnt."""
        if len(self.known) + len(words) > REMEMBERED:
            self.forget()
        known = self.known
        fresh = [w for w in words if w not in known]
        if fresh:
            self._learn(fresh)
        return np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all texts on end, each with the end of a document; where each text starts
        among them; where they can be cut, and what a cut there costs."""
        data, starts = text_bytes(texts)
        raw = data.tobytes()
        begin, stop, doc = runs_of(np.frombuffer(raw.translate(_IS_LETTER), dtype=bool), starts)
        ends = np.concatenate([[0], np.cumsum(stop - begin)]).astype(np.int64)
        words = pa.LargeStringArray.from_buffers(
            len(begin), pa.py_buffer(ends.tobytes()), pa.py_buffer(raw.translate(None, _BLANK))
        ).dictionary_encode()
        number = self.numbers(words.dictionary.to_pylist())
        word = number[words.indices.to_numpy(zero_copy_only=False)] if len(begin) else (
            np.zeros(0, dtype=np.int64))
        sizes = (self.starts[1:] - self.starts[:-1])[word]
        past = np.cumsum(sizes)
        count = int(past[-1]) if len(past) else 0
        total = count + len(texts)
        # where each token's id stands among those of known words
        step = np.repeat((self.starts[word] - (past - sizes)).astype(np.int32), sizes)
        flat = self.ids[step + np.arange(count, dtype=np.int32)]
        place = past - sizes + doc  # behind the words before and the ends of documents
        tokens = np.bincount(doc, weights=sizes, minlength=len(texts)).astype(np.int64) + 1
        opened = np.concatenate([[0], np.cumsum(tokens)])
        ids = np.insert(flat, opened[1:] - np.arange(1, len(texts) + 1), END_ID)
        lines = np.concatenate([[0], np.cumsum(data == 10)])
        last = np.ones(len(doc), dtype=bool)  # the word ends a line, or its document
        last[:-1] = (doc[1:] != doc[:-1]) | (lines[begin[1:]] > lines[stop[:-1]])
        price = np.full(total + 1, np.inf)
        after = place + sizes
        price[after[_IS_END[data[stop - 1]]]] = AT_SENTENCE
        price[after[last]] = AT_LINE
        price[opened[1:]] = 0.0  # the ends of documents, after END_ID
        at = np.flatnonzero(price[1:] < np.inf) + 1
        return ids, opened, *filled(at, price[at])


#: For bytes.translate, which is the fastest way through a text.
_BLANK = bytes(np.flatnonzero(IS_BLANK))
_IS_LETTER = bytes(~IS_BLANK)
_IS_END = np.zeros(256, dtype=bool)
_IS_END[list(b".!?")] = True


def filled(at: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Adds a place every LONGEST tokens where the next one is further away."""
    gaps = np.diff(at, prepend=0)
    wide = np.flatnonzero(gaps > LONGEST)
    if not len(wide):
        return at, cost
    more = np.concatenate([np.arange(at[i] - gaps[i] + LONGEST, at[i], LONGEST) for i in wide])
    at, cost = np.concatenate([at, more]), np.concatenate([cost, np.full(len(more), ANYWHERE)])
    order = np.argsort(at, kind="stable")
    return at[order], cost[order]


class Cuts:
    """The cheapest cuts of a line of tokens that comes stretch by stretch.

    Places come in order, none further than ``width`` from the one before. A cut is settled once
    all cuts that a later window may begin at have it behind them: whatever follows, the cheapest
    way to the end goes through it. Until then it waits, so the cuts are the cheapest of the whole
    line, however it is stretched. Ties take the longest window.
    """

    def __init__(self, width: int = WIDTH):
        self.width = width
        self.where, self.best, self.before = [0], [0.0], [0]
        self.queue: deque[tuple[float, int]] = deque([(0.0, 0)])  # (best + place, cut), rising
        self.dropped = 0  # cuts that were settled and given away; numbers go on behind them

    def add(self, at: np.ndarray, cost: np.ndarray) -> None:
        old, first = len(self.where), self.dropped
        place = np.concatenate([np.array(self.where, dtype=np.int64), at])
        pairs = []
        for power in POWERS:
            if power <= self.width:
                j = np.searchsorted(place, place[old:] - power)
                hit = np.flatnonzero(place[j] == place[old:] - power)
                pairs.append(np.stack([hit + old, j[hit]]))
        exact = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), dtype=np.int64)
        order = np.argsort(exact[0], kind="stable")
        exact_to, exact_from = exact[0][order].tolist() + [-1], exact[1][order].tolist()
        where, best, before, queue = self.where, self.best, self.before, self.queue
        width, k = self.width, 0
        for j, (spot, price) in enumerate(zip(at.tolist(), cost.tolist(), strict=True), old):
            while where[queue[0][1] - first] < spot - width:
                queue.popleft()
            value, i = queue[0]
            value, i = value + width - spot, i - first
            while exact_to[k] == j:
                if best[exact_from[k]] < value:
                    value, i = best[exact_from[k]], exact_from[k]
                k += 1
            value += price + PER_WINDOW
            where.append(spot)
            best.append(value)
            before.append(i + first)
            key = value + spot
            while queue and queue[-1][0] > key:
                queue.pop()
            queue.append((key, j + first))

    def settled(self, last: bool = False) -> list[int]:
        """The places of the cuts that are certain by now; with ``last`` all, to the end."""
        where, before, first = self.where, self.before, self.dropped
        if last:
            common = len(where) - 1
        else:
            # a later window begins at one of these; their ways meet at the common cut
            live = set(range(bisect_left(where, where[-1] - self.width), len(where)))
            heap = [-i for i in live]
            heapify(heap)
            while len(heap) > 1:
                i = -heappop(heap)
                j = before[i] - first
                if i and j not in live:
                    live.add(j)
                    heappush(heap, -j)
            common = -heap[0]
        cuts, j = [], common
        while j > 0:
            cuts.append(where[j])
            j = before[j] - first
        if common > 0:
            self.dropped += common
            self.where, self.best = where[common:], self.best[common:]
            self.before = [self.dropped, *before[common + 1:]]
            while self.queue and self.queue[0][1] < self.dropped:
                self.queue.popleft()
        return cuts[::-1]


def best_cuts(at: np.ndarray, cost: np.ndarray, width: int = WIDTH) -> list[int]:
    """The cheapest cuts of a whole line of tokens, by number in ``at``, the last of which is the
    end of the line."""
    cuts = Cuts(width)
    cuts.add(at, cost)
    return np.searchsorted(at, cuts.settled(last=True)).tolist()


class Packer:
    """Takes documents in order and gives the pieces of sequences that are settled."""

    def __init__(self, width: int = WIDTH):
        self.cuts, self.sequence = Cuts(width), 0
        self.docs: deque = deque()  # [doc_id, ids, tokens, taken so far]
        self.tokens = self.done = 0

    def add(self, doc_ids: list, ids: np.ndarray, opened: np.ndarray, at: np.ndarray,
            cost: np.ndarray) -> None:
        for doc_id, start, stop in zip(
            doc_ids, opened[:-1].tolist(), opened[1:].tolist(), strict=True
        ):
            self.docs.append([doc_id, ids[start:stop], stop - start, 0])
        self.cuts.add(at + self.tokens, cost)
        self.tokens += len(ids)

    def pieces(self, last: bool = False) -> Iterator[tuple]:
        """(doc_id, start, ids, doc_tokens, sequence, offset) of the windows that are settled."""
        for cut in self.cuts.settled(last):
            offset = 0
            while self.done < cut:
                doc = self.docs[0]
                length = min(doc[2] - doc[3], cut - self.done)
                yield (doc[0], doc[3], doc[1][doc[3]:doc[3] + length].tobytes(), doc[2],
                       self.sequence, offset)
                doc[3] += length
                self.done += length
                offset += length
                if doc[3] == doc[2]:
                    self.docs.popleft()
            self.sequence += 1


def pack(docs: DataFrame, tokenizer: str | None = None, width: int = WIDTH) -> DataFrame:
    """One row per piece: doc_id, start, ids, doc_tokens, sequence_id, offset.

    Takes doc_id and text; other columns are left out. ``ids`` are little-endian unsigned
    32-bit ids as bytes; the pieces of a document in order give its ids with END_ID after them.
    A null or empty text is the document of END_ID alone. Repeated rows are packed each on its
    own. An empty table gives no rows. ``tokenizer`` is the path of a tokenizer file.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset"]
    id_type = to_arrow_type(rows.schema["doc_id"].dataType)
    types = [id_type, pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33
        coder, packer = Tokens.shared(tokenizer), Packer(width)

        def out(last: bool) -> pa.RecordBatch:
            found = [(d, s, i, t, first + q, o) for d, s, i, t, q, o in packer.pieces(last)]
            columns = zip(*found, strict=True) if found else [[]] * len(names)
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), type=k) for c, k in zip(columns, types, strict=True)],
                names=names,
            )

        for batch in slices(batches, "text"):
            packer.add(batch.column("doc_id").to_pylist(), *coder.encode(batch.column("text")))
            yield out(False)
        yield out(True)

    small_batches(docs.sparkSession)
    return rows.mapInArrow(
        run, f"doc_id {kind}, start long, ids binary, doc_tokens long, sequence_id long, "
        "offset long",
    )


def digest(pieces: DataFrame) -> DataFrame:
    """Pieces with their length and checksum in place of their ids."""
    return pieces.select(
        "doc_id", "start", F.expr("octet_length(ids) div 4").cast("long").alias("length"),
        F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(pack(documents(spark, sf_dir)))
