"""SentencePiece encoding and decoding of whole texts with a trained merge vocabulary.

Greedy merging always joins the best pair of neighbours next, the left one of ties. Which pieces it ends with is a
local matter: a sequence of pieces is the one greedy merging gives exactly if every two neighbours stay apart when
they are merged alone, since the merges inside two neighbours are the same in any surroundings. So every prefix of a
text has one last piece: among all vocabulary entries that end there - an automaton finds them in one pass - the one
that stays apart from the last piece of the prefix before it. The table of last pieces holds one number a character,
and the ids are read from it backwards. Time is in proportion to the text, whatever its length.

Texts are cut first wherever no entry of the vocabulary goes across - before word signs, around Latin words and digits,
as far as the given vocabulary allows - and the ids of short words are kept per worker, at most `most` of them.
Characters that the vocabulary lacks become their UTF-8 bytes. Normalisation and decoding are the library's.

Defined results: null is encoded like empty text, to the end id alone. Repeated rows and equal texts are rows of their
own. An empty table gives an empty table. All columns are kept; one named like the result is replaced by it.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DataType, IntegerType, StringType, StructType

WORD_SIGN = "▁"
#: Ways to cut normalised texts, finest first. One is right if no entry of the vocabulary is cut by it.
CUTS = (r"▁*[A-Za-zÀ-ÖØ-öø-ɏ]+|▁*[0-9]|▁*[^▁A-Za-zÀ-ÖØ-öø-ɏ0-9]+|▁+", r"▁*[^▁]+|▁+", r"(?s).+")


class PieceTable:
    """The vocabulary of one model, with what it has learned about pairs and words."""

    def __init__(self, path: str, most: int = 300_000, longest: int = 64):
        from sentencepiece import SentencePieceProcessor

        self.model = m = SentencePieceProcessor(model_file=path)
        self.most, self.longest = most, longest
        ids = [k for k in range(m.get_piece_size()) if not (m.is_control(k) or m.is_unknown(k) or m.is_byte(k) or m.is_unused(k))]
        self.text = {k: m.id_to_piece(k) for k in ids}
        self.score = {m.id_to_piece(k): m.get_score(k) for k in ids}
        self.of_byte = [m.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(m.is_byte(k) for k in self.of_byte):
            raise ValueError("the vocabulary must have a piece for every byte")
        self.end = m.eos_id()
        self.ends_here = ahocorasick.Automaton()
        for k, piece in self.text.items():
            self.ends_here.add_word(piece, k)
        self.ends_here.make_automaton()
        self.cut = re.compile(next((c for c in CUTS if all(len(re.findall(c, piece)) == 1 for piece in self.score)), CUTS[-1]))
        self.apart: dict[tuple[int, int], bool] = {}
        self.known: dict[int, tuple[bool, list[tuple[float, str, str]]]] = {}
        self.words: dict[str, list[int]] = {}

    def merges(self, text: str) -> tuple[list[str], list[tuple[float, str, str]]]:
        """Greedy merging as it is defined: what it ends with; and of each step its score, then the first and last part."""
        parts, steps, none = list(text), [], float("-inf")
        scores = [self.score.get(a + b, none) for a, b in zip(parts, parts[1:])]
        while scores and (best := max(scores)) > none:
            k = scores.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del scores[k]
            if k:
                scores[k - 1] = self.score.get(parts[k - 1] + parts[k], none)
            if k < len(scores):
                scores[k] = self.score.get(parts[k] + parts[k + 1], none)
            steps.append((best, parts[0], parts[-1]))
        return parts, steps

    def history(self, piece: int) -> tuple[bool, list[tuple[float, str, str]]]:
        """Whether merging gives an entry back, and its steps; a character that the vocabulary lacks is -1 - its code."""
        found = self.known.get(piece)
        if found is None:
            text = self.text[piece] if piece >= 0 else chr(-1 - piece)
            parts, steps = self.merges(text)
            found = self.known[piece] = len(parts) == 1, [(float("inf"), text[0], text[-1]), *steps, (float("-inf"), "", "")]
        return found

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether merging the two side by side gives the two back; left is known to be whole.

        The steps of both are taken in order of score, left first. They are apart unless the parts that touch would
        be joined before the next step, or after the last.
        """
        whole, theirs = self.history(right)
        if not whole:
            return False
        ours, score = self.history(left)[1], self.score
        i = j = 0
        while True:
            meet = score.get(ours[i][2] + theirs[j][1])
            a, b = ours[i + 1][0], theirs[j + 1][0]
            if meet is not None and meet > a and meet >= b:
                return False
            if a >= b:
                if a == float("-inf"):
                    return True
                i += 1
            else:
                j += 1

    def last_pieces(self, text: str) -> array:
        """The last piece of every prefix."""
        last, pieces, apart = array("i"), self.text, self.apart
        if len(apart) >= self.most:
            apart.clear()
        for end, piece in self.ends_here.iter(text):
            if len(last) > end:
                continue
            while len(last) < end:  # no entry ends a prefix there: it ends with a character that the vocabulary lacks
                last.append(-1 - ord(text[len(last)]))
            before = end - len(pieces[piece])
            if before < 0:
                fits = self.history(piece)[0]
            else:
                pair = last[before], piece
                fits = apart.get(pair)
                if fits is None:
                    fits = apart[pair] = self.stay_apart(*pair)
            if fits:
                last.append(piece)
        while len(last) < len(text):
            last.append(-1 - ord(text[len(last)]))
        return last

    def word_ids(self, word: str) -> bytes:
        """The ids of what the cut gave, as 32-bit integers."""
        last, out, at = self.last_pieces(word), array("i"), len(word)
        while at:
            piece = last[at - 1]
            if piece >= 0:
                out.append(piece)
                at -= len(self.text[piece])
            else:
                out.extend([self.of_byte[b] for b in reversed(chr(-1 - piece).encode())])
                at -= 1
        out.reverse()
        return out.tobytes()

    def encode(self, text: str | None) -> bytes:
        """The ids of a text as 32-bit integers, with the end id."""
        text, words, out, at = self.model.normalize(text) if text else "", self.words, [], 0
        while at < len(text):
            end = self.end_of_stretch(text, at)
            found = self.cut.findall(text, at, end)
            try:
                out.append(b"".join([words[w] for w in found]))
            except KeyError:
                fresh = {w: self.word_ids(w) for w in set(found) if w not in words}
                out.append(b"".join([fresh[w] if w in fresh else words[w] for w in found]))
                if len(words) >= self.most:
                    words.clear()
                words |= {w: ids for w, ids in fresh.items() if len(w) <= self.longest}
            at = end
        out.append(array("i", [self.end]).tobytes())
        return b"".join(out)

    def end_of_stretch(self, text: str, at: int, step: int = 1 << 20) -> int:
        """Where the cut ends next, some way from here."""
        found = self.cut.search(text, at + step) if at + step < len(text) else None
        if not found:
            return len(text)
        # what is found there may be the rest of a longer word; what follows it begins on its own
        return found.end()


_LOADED: dict[str, PieceTable] = {}


def table(path: str) -> PieceTable:
    """One per worker process."""
    if path not in _LOADED:
        _LOADED[path] = PieceTable(path)
    return _LOADED[path]


def decoder(path: str):
    """The library's decoding of the ids in an Arrow list."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    return lambda ids: model.decode(ids.values.to_numpy().tolist() if ids.is_valid else [])


def _with_column(df: DataFrame, source: str, name: str, kind: DataType, each, most: int = 1 << 22) -> DataFrame:
    """df with a column of each(value), text or the bytes of 32-bit ids; batches are passed on in slices of about so many bytes."""
    kept = [c for c in df.columns if c != name]
    schema = StructType([df.schema[c] for c in kept]).add(name, kind)

    def column(made: list) -> pa.Array:
        if kind == StringType():
            return pa.array(made, pa.string())
        offsets = np.cumsum([0, *(len(m) // 4 for m in made)], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(made), np.int32)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = each()
        for batch in batches:
            values = batch.column(batch.num_columns - 1)
            first, made, size = 0, [], 0
            for k in range(batch.num_rows):
                made.append(one(values[k]))
                size += len(made[-1])
                if size >= most or k == batch.num_rows - 1:
                    rows = batch.slice(first, k + 1 - first)
                    yield pa.RecordBatch.from_arrays([*rows.columns[:-1], column(made)], names=[*kept, name])
                    first, made, size = k + 1, [], 0

    free = "_" * (1 + max(map(len, df.columns)))
    return df.select(*kept, df[source].alias(free)).mapInArrow(work, schema)


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """docs with the ids of each whole text."""
    return _with_column(docs, text, ids, ArrayType(IntegerType()), lambda: lambda text: table(path).encode(text.as_py()))


def decode(encoded: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """encoded with the text that the ids stand for; null ids are no ids."""
    return _with_column(encoded, ids, decoded, StringType(), lambda: decoder(path))
