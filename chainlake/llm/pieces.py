"""SentencePiece encoding of the merge type, exact, by backtracking.

The library merges neighbouring pieces, best score first and leftmost among equals. Two facts
make a search over the text equal to that: a piece of the result is what its own text merges
to, and a sequence of pieces is the result if every two neighbours are, that is if merging
their joined text gives the two again. So an Aho-Corasick automaton lists the pieces that
begin at a place; the longest that goes with the piece before it is taken, and where none
does, the piece before gives way to its next shorter one. The pieces up to a place are
unique, so a place from which the search came back has failed for good, which is kept in a
field of one flag per place.

Texts are cut where no piece can reach across (in front of a space that follows something
else), and each chunk is searched once per worker.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlake.llm.base import gathered, in_slices
from chainlake.llm.bpe import on_worker
from chainlake.llm.chunks import Codes, no_cycles, ranges

SPACE = "▁"
# Bytes of text that are encoded together, and characters of chunks after which a memo starts anew.
GATHER = 8 << 20
MOST_CHARS = 16_000_000
# Remembered verdicts on neighbours.
MOST_PAIRS = 4_000_000


class Characters(dict):
    """The ids of characters; one that is no piece gets a number beyond all ids."""

    def __init__(self, model: Model):
        super().__init__({piece: i for piece, i in model.id_of.items() if len(piece) == 1})
        self.model = model

    def __missing__(self, character: str) -> int:
        i = self[character] = len(self.model.part_of)
        self.model.part_of.append(character)
        self.model.size.append(1)
        self.model.shorter.append(-1)
        return i


class Model:
    """Pieces of a model, their order of merging, and what ids stand for."""

    def __init__(self, path: str):
        library = sentencepiece.SentencePieceProcessor(model_file=path)
        n = library.get_piece_size()
        self.piece_of = [library.id_to_piece(i) for i in range(n)]
        self.unknown = library.unk_id()
        probe = library.normalize(f" Ａ  x{SPACE} ")
        if probe != f"{SPACE}{SPACE}Ａ{SPACE}{SPACE}x{SPACE}{SPACE}":
            raise ValueError("only models that leave characters and spaces as they are, behind one added space, are supported")
        special = {i for i in range(n) if library.is_control(i) or library.is_unknown(i) or library.is_byte(i)}
        if any(library.is_unused(i) for i in range(n)):
            raise ValueError("models with unused pieces are not supported")
        bytes_of = {int(self.piece_of[i][3:5], 16): i for i in range(n) if library.is_byte(i)}
        self.byte_ids = [bytes_of[b] for b in range(256)] if len(bytes_of) == 256 else None
        self.id_of = {self.piece_of[i]: i for i in range(n) if i not in special}
        # Pieces of higher scores merge first.
        self.order = {piece: -library.get_score(i) for piece, i in self.id_of.items()}
        self.cuts = not any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in self.id_of)
        # Only pieces that are what their own text merges to can come out.
        whole = {piece: i for piece, i in self.id_of.items() if len(piece) > 1 and self.remerged(piece, 0)}
        self.automaton = ahocorasick.Automaton()
        for piece, i in whole.items():
            self.automaton.add_word(piece, (len(piece) - 1, i))
        self.automaton.make_automaton()
        self.part_of = list(self.piece_of)
        self.size = [len(piece) for piece in self.piece_of]
        # The longest such piece that begins a piece without being all of it.
        self.shorter = [-1] * n
        self.character = Characters(self)
        for piece, i in whole.items():
            begins = (whole.get(piece[:size]) for size in range(len(piece) - 1, 1, -1))
            self.shorter[i] = next((j for j in begins if j is not None), None) or self.character[piece[0]]
        self.pairs: dict[tuple[int, int], bool] = {}
        # What ids stand for; control ids stand for nothing.
        surface = [piece.replace(SPACE, " ").encode() for piece in self.piece_of]
        for i in special:
            surface[i] = b""
        for byte, i in bytes_of.items():
            surface[i] = bytes([byte])
        surface[self.unknown] = " ⁇ ".encode()
        self.opens = np.array([piece.startswith(SPACE) for piece in self.piece_of])
        self.silent = np.array([library.is_control(i) for i in range(n)])
        self.blob = np.frombuffer(b"".join(surface), dtype=np.uint8)
        self.blob_len = np.array([len(s) for s in surface], dtype=np.int64)
        self.blob_at = np.cumsum(self.blob_len) - self.blob_len
        self.text_of = [str(i) for i in range(n)]

    def remerged(self, text: str, border: int) -> bool:
        """Merge the characters of a short text, best piece first; tells whether nothing is
        merged across ``border`` and, where that is 0, whether one piece comes out."""
        parts = list(text)
        ends = list(range(1, len(parts) + 1))
        order = self.order.get
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = order(parts[i] + parts[i + 1])
                if score is not None and (best is None or score < best):
                    best, at = score, i
            if best is None:
                break
            if ends[at] == border:
                return False
            parts[at] += parts.pop(at + 1)
            ends.pop(at)
        return border > 0 or len(parts) == 1

    def go_together(self, pair: tuple[int, int]) -> bool:
        """Whether two pieces stay apart when their joined text is merged."""
        if len(self.pairs) > MOST_PAIRS:
            self.pairs.clear()
        left, right = self.part_of[pair[0]], self.part_of[pair[1]]
        known = self.pairs[pair] = self.remerged(left + right, len(left))
        return known

    def search(self, chunk: str) -> list[int]:
        """The pieces of a chunk; characters that are none as the numbers given to them."""
        size, shorter, known = self.size, self.shorter, self.pairs.get
        # The longest piece that begins at each place: of those found, the last.
        longest = list(map(self.character.__getitem__, chunk))
        for last, (back, i) in self.automaton.iter(chunk):
            longest[last - back] = i
        n = len(chunk)
        failed = bytearray(n + 1)
        taken: list[int] = []
        at, before, i = 0, -1, longest[0]
        while True:
            stop = at + size[i]
            if not failed[stop]:
                pair = (before, i)
                fits = before < 0 or known(pair)
                if fits is None:
                    fits = self.go_together(pair)
                if fits:
                    taken.append(i)
                    if stop == n:
                        return taken
                    at, before, i = stop, i, longest[stop]
                    continue
            i = shorter[i]
            while i < 0:
                failed[at] = 1
                i = taken.pop()
                at -= size[i]
                before = taken[-1] if taken else -1
                i = shorter[i]

    def ids(self, chunk: str) -> list[int]:
        """The ids of a chunk; a character that is no piece becomes its bytes, where the model
        has them."""
        found = self.search(chunk)
        n = len(self.piece_of)
        if max(found) < n:
            return found
        out: list[int] = []
        for i in found:
            if i < n:
                out.append(i)
            elif self.byte_ids:
                out.extend(map(self.byte_ids.__getitem__, self.part_of[i].encode()))
            else:
                out.append(self.unknown)
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text that ids stand for: without the space in front, each byte that is part of
        no character as U+FFFD."""
        # Bytes on both sides of a control id are not read together.
        mute = self.silent[ids]
        runs = np.split(ids, np.flatnonzero(mute)) if mute.any() else [ids]
        loud = ids[~mute]
        parts = [self.blob[ranges(self.blob_at[run], self.blob_len[run])].tobytes() for run in runs]
        made = "".join(part.decode() if valid(part) else "".join(apart(part)) for part in parts)
        return made[1:] if len(loud) and self.opens[loud[0]] else made


def valid(raw: bytes) -> bool:
    try:
        raw.decode()
    except UnicodeDecodeError:
        return False
    return True


def apart(raw: bytes) -> Iterator[str]:
    """The characters of bytes; every byte that is part of none by itself as U+FFFD."""
    at = 0
    while at < len(raw):
        try:
            yield raw[at:].decode()
            return
        except UnicodeDecodeError as bad:
            yield raw[at : at + bad.start].decode()
            yield "�"
            at += bad.start + 1


class Encoder:
    """Encodes texts; keeps the ids of chunks it has met."""

    def __init__(self, path: str):
        self.model = Model(path)
        self.runs = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        self.forget()

    def forget(self) -> None:
        self.codes, self.size = Codes(), 0
        self.flat, self.lens = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def chunks(self, text: str) -> list[str]:
        """A text as the model sees it, cut in front of spaces that follow something else."""
        if not text:
            return []
        seen = SPACE + text.replace(" ", SPACE)
        if not self.model.cuts:
            return [seen]
        parts = seen.split(SPACE)[1:]
        return self.runs.findall(seen) if "" in parts else [SPACE + part for part in parts]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if self.size > MOST_CHARS:
            self.forget()
        known = len(self.codes)
        look = self.codes.__getitem__
        with no_cycles():
            made = [np.fromiter(map(look, parts), np.int64, len(parts)) for parts in map(self.chunks, texts)]
            fresh = list(self.codes)[known:]
            found = [self.model.ids(chunk) for chunk in fresh]
        self.flat = np.concatenate([self.flat, np.fromiter((i for ids in found for i in ids), np.int32)])
        self.lens = np.concatenate([self.lens, np.array([len(ids) for ids in found], dtype=np.int64)])
        self.size += sum(map(len, fresh))
        begins = np.cumsum(self.lens) - self.lens
        return [self.flat[ranges(begins[codes], self.lens[codes])] for codes in made]

    def digests(self, ids: np.ndarray) -> tuple[int, str, str]:
        """Number of ids, digest of the ids, digest of the text that the ids stand for."""
        joined = ",".join(map(self.model.text_of.__getitem__, ids.tolist()))
        return len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(self.model.decode(ids).encode()).hexdigest()


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for all tasks of a worker, so that its memo is used again."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(on_worker(path))
    return _ENCODERS[path]


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Append the ids of each row's text as an array column, without begin or end ids.

    Null and empty texts give an empty array. Rows are independent of one another: repeated
    rows give repeated results. A column that already has the name ``ids`` is replaced.
    """
    others = [c for c in docs.columns if c != ids]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in others)
    source = docs.select(*[F.col(f"`{c}`") for c in others], F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for got in gathered(batches, "_text", GATHER):
            made = iter(coder.encode(got["_text"].to_pylist()))
            for batch in in_slices(got):
                found = pa.array([next(made).tolist() for _ in range(batch.num_rows)], pa.list_(pa.int32()))
                columns = [batch.column(batch.schema.get_field_index(c)) for c in others]
                yield pa.RecordBatch.from_arrays([*columns, found], names=[*others, ids])

    return source.mapInArrow(run, f"{fields}{', ' if fields else ''}`{ids}` array<int>")


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Append the text an array of ids stands for; null and empty arrays give an empty text.
    Null ids and ids the model does not have are an error."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != out)
    source = df.select(*[F.col(f"`{c}`") for c in df.columns if c != out])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(path).model
        for batch in batches:
            rows = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            made = [model.decode(np.array(row or [], dtype=np.int64)) for row in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], names=[*batch.schema.names, out])

    return source.mapInArrow(run, f"{fields}, `{out}` string")


def round_trip(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode each text, decode its ids, and return digests of both per row:
    ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    Null and empty texts have no ids and the digests of nothing. One row per input row,
    repeated rows and null ids included; columns other than the two named are ignored. A
    long text without spaces is one chunk: memory grows with it by a few bytes a character
    and by its pieces.
    """
    source = docs.select(F.col(f"`{id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for got in gathered(batches, "text", GATHER):
            made = iter(coder.encode(got["text"].to_pylist()))
            for batch in in_slices(got):
                counts, ids, texts = zip(*[coder.digests(next(made)) for _ in range(batch.num_rows)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids), pa.array(texts)],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return source.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
