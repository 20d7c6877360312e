"""Encoding and decoding with a SentencePiece vocabulary by a Viterbi pass over a trie of distinct words.

A text is cut into marked words (a run of word marks and what follows up to the next mark); no piece spans two of them.
The distinct words of many texts are sorted, which walks their trie depth-first: a word keeps the forward states of the
prefix it shares with the word before it, and only the rest of the word is scored. Each text's ids are then gathered
from those of its words.

For unigram vocabularies the forward state of a prefix is its best score and last piece. For BPE vocabularies scores do
not add up; there the state is the last piece of the prefix's BPE encoding, which is the one piece that may follow the
state before it (two pieces may follow each other if BPE leaves their concatenation as these two).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keeprule.llm.common import coded_units, pieces, run_positions, slices, text_bytes

MARK = "▁"
#: Bytes of text, or ids, that are worked on at once.
AT_ONCE, IDS_AT_ONCE = 2_000_000, 600_000
#: Words and pairs of pieces that a task keeps at most, but for those of one text.
KNOWN_WORDS, KNOWN_PAIRS = 700_000, 400_000


@dataclass
class Vocabulary:
    """Pieces in order of their ids; ``text`` are those that match text, ``bytes_of`` what every id decodes to."""

    text: dict[str, int]
    scores: list[float]
    bytes_of: list[bytes]
    byte_ids: list[int]
    unknown: int
    bpe: bool

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """From a SentencePiece model file. Only models that leave texts as they are (identity) are taken."""
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        norm = model.normalizer_spec
        kinds = (model.trainer_spec.UNIGRAM, model.trainer_spec.BPE)
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or model.trainer_spec.model_type not in kinds:
            raise ValueError("only unigram and BPE models with identity normalisation and a leading mark are supported")
        kind = proto.ModelProto.SentencePiece
        text, bytes_of, byte_ids, unknown = {}, [], [], 0
        for number, piece in enumerate(model.pieces):
            content = piece.piece.replace(MARK, " ").encode()
            if piece.type in (kind.NORMAL, kind.USER_DEFINED):
                text[piece.piece] = number
            elif piece.type == kind.BYTE:
                byte_ids.append(number)
                content = bytes([int(piece.piece[3:5], 16)])
            else:
                unknown = number if piece.type == kind.UNKNOWN else unknown
                content = " ⁇ ".encode() if piece.type == kind.UNKNOWN else b""
            bytes_of.append(content)
        scores = [p.score for p in model.pieces]
        return cls(text, scores, bytes_of, byte_ids, unknown, model.trainer_spec.model_type == model.trainer_spec.BPE)


def marked(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and offsets of ``texts`` with marks for spaces, and one in front of each that is not empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    lead = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", MARK).cast(pa.large_string())
    empty = pa.scalar("", pa.large_string())
    return text_bytes(pc.binary_join_element_wise(lead, pc.replace_substring(texts, " ", MARK), empty))


def word_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where words of texts that lie behind each other start: at texts, and at marks that follow no mark."""
    one, two, three = MARK.encode()
    marks = np.flatnonzero(data == one)
    marks = marks[marks + 2 < len(data)]
    marks = marks[(data[marks + 1] == two) & (data[marks + 2] == three)]
    cut = np.zeros(len(data), bool)
    cut[marks[np.diff(marks, prepend=-len(MARK.encode()) - 1) != len(MARK.encode())]] = True
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(cut)


class Encoder:
    """Encodes sorted distinct words, sharing the states of common prefixes."""

    def __init__(self, vocabulary: Vocabulary, known_words: int = KNOWN_WORDS):
        self.v, self.known_words = vocabulary, known_words
        self.follows: dict[tuple[str, str], bool] = {}
        #: Row of each word already encoded in ``flat`` (its ids), ``ends`` and ``again`` (met in a later slice too).
        self.known: dict[str, int] = {}
        self.flat, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.again = np.zeros(0, bool)
        text = vocabulary.text
        long: dict[str, set[int]] = {}
        for piece in text:
            if len(piece) > 2:
                long.setdefault(piece[-3:], set()).add(len(piece))
        # Possible lengths of a piece by its last three characters, longest first; and by the last two or one.
        self.two = {piece: [2, *([1] if piece[1] in text else [])] for piece in text if len(piece) == 2}
        self.one = {piece: [1] for piece in text if len(piece) == 1}
        self.lengths = {
            end: sorted(found, reverse=True) + (self.two.get(end[1:]) or self.one.get(end[2], [])) for end, found in long.items()
        }

    def merged(self, symbols: list[str]) -> list[str]:
        """BPE: join the neighbours whose piece has the best score, the leftmost first, until none can be joined."""
        text, scores = self.v.text, self.v.scores
        while True:
            best, at = None, -1
            for k in range(len(symbols) - 1):
                found = text.get(symbols[k] + symbols[k + 1])
                if found is not None and (best is None or scores[found] > best):
                    best, at = scores[found], k
            if at < 0:
                return symbols
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]

    def may_follow(self, before: str, piece: str) -> bool:
        known = self.follows.get((before, piece))
        if known is None:
            want = [before, piece] if before else [piece]
            known = self.follows[before, piece] = self.merged(list(before + piece)) == want
        return known

    def fallback(self, char: str) -> list[int]:
        return [self.v.byte_ids[b] for b in char.encode()] if len(self.v.byte_ids) == 256 else [self.v.unknown]

    def encode(self, words: list[str]) -> list[list[int]]:
        """Ids of each word; ``words`` are sorted and not empty."""
        states = self._bpe_states if self.v.bpe else self._unigram_states
        text, out = self.v.text, []
        for word, last in zip(words, states(words), strict=True):
            ids, end = [], len(word)
            while end:
                piece = last[end]
                found = text.get(piece)
                ids.append(self.fallback(piece) if found is None else [found])
                end -= len(piece)
            out.append([i for part in reversed(ids) for i in part])
        return out

    @staticmethod
    def _shared(words: list[str]) -> Iterator[tuple[str, int]]:
        """Each word with the length of the prefix it shares with the one before."""
        before = ""
        for word in words:
            shared = 0
            for x, y in zip(word, before):
                if x != y:
                    break
                shared += 1
            before = word
            yield word, shared

    def _bpe_states(self, words: list[str]) -> Iterator[list[str]]:
        """For each word the last piece of every prefix."""
        text, follows, lengths, two, one = self.v.text, self.follows, self.lengths, self.two, self.one
        last = [""]
        for word, shared in self._shared(words):
            del last[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                char = word[end - 1]
                three = word[end - 3 : end] if end > 2 else word[:end]
                for n in lengths.get(three) or two.get(three[-2:]) or one.get(char, ()):
                    if n <= end and (piece := word[end - n : end]) in text:
                        pair = last[end - n], piece
                        known = follows.get(pair)
                        if self.may_follow(*pair) if known is None else known:
                            last.append(piece)
                            break
                else:
                    last.append(char)
            yield last

    def _unigram_states(self, words: list[str]) -> Iterator[list[str]]:
        """For each word the last piece of the best segmentation of every prefix."""
        text, scores, lengths, two, one = self.v.text, self.v.scores, self.lengths, self.two, self.one
        unknown = min(scores) - 10.0
        last, best = [""], [0.0]
        for word, shared in self._shared(words):
            del last[shared + 1 :], best[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                char = word[end - 1]
                score, piece = best[end - 1] + (unknown if char not in text else scores[text[char]]), char
                three = word[end - 3 : end] if end > 2 else word[:end]
                for n in lengths.get(three) or two.get(three[-2:]) or one.get(char, ()):
                    if n <= end and (found := text.get(word[end - n : end])) is not None and best[end - n] + scores[found] > score:
                        score, piece = best[end - n] + scores[found], word[end - n : end]
                last.append(piece)
                best.append(score)
            yield last

    def _forget(self) -> None:
        """Leave only the words that were met again since the last time, so that rare ones don't fill the table."""
        kept = [word for word, row in self.known.items() if self.again[row]]
        if 2 * len(kept) > self.known_words:
            kept = []
        rows = np.fromiter(map(self.known.__getitem__, kept), np.int64, len(kept))
        n = np.diff(self.ends)[rows]
        self.flat = self.flat[np.repeat(self.ends[rows], n) + run_positions(n)]
        self.ends = np.concatenate([[0], np.cumsum(n)])
        self.known, self.again = {word: row for row, word in enumerate(kept)}, np.zeros(len(kept), bool)

    def _rows(self, words: list[str]) -> np.ndarray:
        """Rows of ``words`` in the table of encoded words, to which new ones are added."""
        if len(self.follows) > KNOWN_PAIRS:
            self.follows.clear()
        if len(self.known) + len(words) > self.known_words:
            self._forget()
        new, before = sorted(word for word in words if word not in self.known), len(self.known)
        self.known.update(zip(new, range(before, before + len(new)), strict=True))
        ids = self.encode(new)
        ends = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids))) + self.ends[-1]
        self.ends = np.concatenate([self.ends, ends])
        self.flat = np.concatenate([self.flat, np.fromiter((i for x in ids for i in x), np.int32)])
        rows = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        self.again = np.concatenate([self.again, np.zeros(len(new), bool)])
        self.again[rows[rows < before]] = True
        return rows

    def encode_texts(self, texts: pa.Array | list[str]) -> pa.ListArray:
        """Ids of each text; a null has none."""
        data, offsets = marked(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        starts = word_starts(data, offsets)
        counts = np.diff(np.searchsorted(starts, offsets))
        coded = coded_units(data, starts)
        words = coded.dictionary.to_pylist()
        rows = self._rows(words)
        lengths, starts = np.diff(self.ends)[rows], self.ends[rows]
        code = coded.indices.to_numpy()
        n = lengths[code]
        gathered = self.flat[np.repeat(starts[code], n) + run_positions(n)]
        ends = np.concatenate([[0], np.cumsum(n)])
        offsets = ends[np.concatenate([[0], np.cumsum(counts)])]
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(gathered, pa.int32()))


class Decoder:
    """Turns ids into text, for many texts at once."""

    def __init__(self, bytes_of: list[bytes]):
        self.lengths = np.array([len(b) for b in bytes_of], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(bytes_of), np.uint8)

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """The texts without their leading marks; null where the ids are null."""
        values = ids.flatten().to_numpy()
        n = self.lengths[values]
        data = self.flat[np.repeat(self.starts[values], n) + run_positions(n)].tobytes()
        counts = pc.fill_null(pc.list_value_length(ids), 0).to_numpy()
        ends = np.concatenate([[0], np.cumsum(n)])[np.cumsum(counts)].tolist()
        texts, start = [], 0
        for end, known in zip(ends, ids.is_valid().to_pylist(), strict=True):
            text = data[start + (data[start : start + 1] == b" " and end > start) : end].decode("utf-8", "replace")
            texts.append(text if known else None)
            start = end
        return pa.array(texts, pa.string())


def _coded(docs: DataFrame, vocabulary: Vocabulary, keep: tuple[str, ...], known_words: int, with_text: bool) -> DataFrame:
    kept = list(dict.fromkeys(["doc_id", *keep]))
    shared = docs.sparkSession.sparkContext.broadcast(vars(vocabulary))
    schema = ", ".join(f"`{name}` {kind}" for name, kind in docs.select(*kept).dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(**shared.value), known_words)
        decoder = Decoder(encoder.v.bytes_of)
        for batch in batches:
            for part in pieces(batch, "coded text", AT_ONCE):
                texts = part.column("coded text")
                ids = encoder.encode_texts(texts)
                n = pa.array(np.diff(ids.offsets.to_numpy()).astype(np.int64))
                if texts.null_count:
                    ids = pa.ListArray.from_arrays(ids.offsets, ids.values, mask=texts.is_null())
                columns, names = [*(part.column(name) for name in kept), n, ids], [*kept, "n_ids", "ids"]
                if with_text:
                    columns, names = [*columns, decoder.decode(ids)], [*names, "text"]
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(*kept, F.col("text").alias("coded text"))
    return rows.mapInArrow(run, f"{schema}, n_ids long, ids array<int>" + ", text string" * with_text)


def encode(docs: DataFrame, vocabulary: Vocabulary, *keep: str, known_words: int = KNOWN_WORDS) -> DataFrame:
    """The columns doc_id and ``keep`` of every row of ``docs`` with ``ids`` and n_ids.

    A null text has null ids, an empty one an empty list; n_ids is 0 for both. Repeated rows are encoded each for
    itself. A mark (U+2581) in a text counts as a space. A task keeps the ids of about ``known_words`` words, of some
    250 bytes each: more of them save time, fewer memory; the result is the same.
    """
    return _coded(docs, vocabulary, keep, known_words, with_text=False)


def round_trip(docs: DataFrame, vocabulary: Vocabulary, *keep: str, known_words: int = KNOWN_WORDS) -> DataFrame:
    """As ``encode``, with the text that the ids decode to as ``text``, in one pass; null where the text is null."""
    return _coded(docs, vocabulary, keep, known_words, with_text=True)


def decode(coded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The rows of ``coded`` with ``text`` decoded from their ``ids``; null ids give a null text."""
    shared = coded.sparkSession.sparkContext.broadcast(vocabulary.bytes_of)
    names = [c for c in coded.columns if c != "text"]
    schema = ", ".join(f"`{name}` {kind}" for name, kind in coded.select(*names).dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared.value)
        for batch in batches:
            counts = pc.fill_null(pc.list_value_length(batch.column("ids")), 0).to_numpy()
            for part in slices(batch, np.concatenate([[0], np.cumsum(counts)]), IDS_AT_ONCE):
                columns = [part.column(name) for name in names]
                yield pa.RecordBatch.from_arrays([*columns, decoder.decode(part.column("ids"))], [*names, "text"])

    return coded.select(*names).mapInArrow(run, f"{schema}, text string")
