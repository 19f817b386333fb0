"""Secret scans by token efficiency.

Text that a tokenizer has learned takes several characters per token; random strings take
fewer than two. Runs of key-like characters are measured under a public vocabulary, after
what is known to be harmless (digests, identifiers, plain numbers) has been set aside: as a
whole, then by their parts and by stretches of their tokens, as words may lead to a secret.
Besides, three forms of secrets are found by pattern.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlake.llm.base import by_batch
from chainlake.llm.bpe import on_worker

KINDS = ("assign", "access", "hex", "dense")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# Runs of 16 and more are those runs of one and more that are long enough.
HEX = re.compile(r"[0-9a-f]{16,}")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")

# A run with fewer characters per token is random; longer words of any language have more.
LEAST_RATIO = 1.8
# Lengths in hexadecimal digits of common digests: 128, 160, 192, 224, 256, 384, 512 bits.
DIGESTS = (32, 40, 48, 56, 64, 96, 128)
KNOWN = re.compile(
    r"(?:[0-9a-f]+|[0-9A-F]+)"
    r"|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
)
NUMBER = re.compile(r"[0-9+/_=-]+")
# Characters that a stretch within a run has at least.
LEAST_STRETCH = 20
# What breaks a run: digests and identifiers that stand alone between its separators.
HARMLESS = re.compile(
    r"(?<![A-Za-z0-9+])(?:[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
    + "".join(rf"|[0-9a-f]{{{n}}}|[0-9A-F]{{{n}}}" for n in DIGESTS)
    + r")(?![A-Za-z0-9+])"
)
PART = re.compile(r"[A-Za-z0-9+]{%d,}" % LEAST_STRETCH)
LETTER = re.compile(r"[A-Za-z]")
# Capitals only, or several words between separators.
WORDS = re.compile(r"[A-Z]+|[+/_=-]*(?:(?:[A-Z]?[a-z]+|[A-Z]+)[+/_=-]+)+(?:[A-Z]?[a-z]*|[A-Z]+)")


def known(run: str) -> bool:
    """A digest in hexadecimal, an identifier with the form of a UUID, or digits only."""
    if NUMBER.fullmatch(run):
        return True
    if not KNOWN.fullmatch(run):
        return False
    return "-" in run or len(run) in DIGESTS


@lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str) -> tiktoken.Encoding:
    with open(on_worker(path), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("efficiency", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def lettered(run: str) -> bool:
    """Whether a run can be random text: it has letters, and they are not the plain words of
    a path or name, each in one case or capitalised, nor capitals only."""
    if not any(c.isalpha() for c in run):
        return False
    return any(c.isdigit() for c in run) or not WORDS.fullmatch(run)


def is_dense(run: str, coder: tiktoken.Encoding, least: float = LEAST_RATIO) -> bool:
    """A run that takes too many tokens for its length."""
    if not lettered(run) or known(run):
        return False
    return len(run) < least * len(coder.encode_ordinary(run))


def dense_stretches(run: str, coder: tiktoken.Encoding, least: float = LEAST_RATIO) -> list[tuple[int, int]]:
    """Parts between separators, and stretches of tokens, that take too many tokens for
    their length; joined where they meet."""
    found = [m.span() for m in PART.finditer(run) if is_dense(m[0], coder, least)]
    at = 0
    for begin, after in [*(m.span() for m in HARMLESS.finditer(run)), (len(run), len(run))]:
        piece = run[at:begin]
        if len(piece) >= LEAST_STRETCH:
            cuts = [0]
            for token in coder.decode_tokens_bytes(coder.encode_ordinary(piece)):
                cuts.append(cuts[-1] + len(token))
            last = 0
            for first, start in enumerate(cuts):
                while last < len(cuts) and cuts[last] - start < LEAST_STRETCH:
                    last += 1
                if last == len(cuts):
                    break
                stretch = piece[start : cuts[last]]
                dense = len(stretch) < least * (last - first) and lettered(stretch)
                # Dates and versions are digits and separators with few letters.
                if dense and 4 * len(LETTER.findall(stretch)) >= len(stretch):
                    found.append((at + start, at + cuts[last]))
        at = after
    joined = covered([(s, 0, e) for s, e in sorted(found)])
    return [(s + len(run[s:e]) - len(run[s:e].lstrip("/_=-")), e) for s, e in joined]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the patterns find."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def dense_spans(text: str, coder: tiktoken.Encoding, least: float = LEAST_RATIO) -> list[tuple[int, int, int]]:
    found = []
    for m in RUN.finditer(text):
        if is_dense(m[0], coder, least):
            found.append((m.start(), 3, m.end()))
        elif not known(m[0]):
            found += [(m.start() + s, 3, m.start() + e) for s, e in dense_stretches(m[0], coder, least)]
    return found


def shown(spans: list[tuple[int, int, int]]) -> str:
    return ",".join([f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans])


def scan(
    docs: DataFrame, path: str, pattern: str, least: float = LEAST_RATIO, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Spans of secrets in every text: ``doc_id, n_assign, n_access, n_hex, n_dense,
    base_sha256, spans``; positions are code points, ends exclusive.

    A span may lie in one of another kind. Null and empty texts have none. One row per
    input row, repeated rows and null ids included; other columns are ignored.
    """
    source = docs.select(F.col(f"`{id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = vocabulary(path, pattern)
        counts: list[list[int]] = [[] for _ in KINDS]
        base_out, out = [], []
        for row in batch.column("text").to_pylist():
            base = base_spans(row)
            spans = sorted(base + dense_spans(row, coder, least))
            for k, column in enumerate(counts):
                column.append(sum(s[1] == k for s in spans))
            base_out.append(hashlib.sha256(shown(base).encode()).hexdigest())
            out.append(shown(spans))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in counts], pa.array(base_out), pa.array(out)],
            names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"],
        )

    return by_batch(
        source, run,
        f"doc_id {kind}, n_assign long, n_access long, n_hex long, n_dense long, base_sha256 string, spans string",
    )


def covered(spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Spans joined where they overlap."""
    out: list[tuple[int, int]] = []
    for start, _, end in spans:
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def redact(
    docs: DataFrame, path: str, pattern: str, mark: str = "<secret>", least: float = LEAST_RATIO, text: str = "text"
) -> DataFrame:
    """Every text with its secrets replaced by ``mark``; all other columns stay as they are.
    Null stays null; texts without secrets are unchanged."""
    others = [c for c in docs.columns if c != text]
    source = docs.select(*[F.col(f"`{c}`") for c in others], F.col(f"`{text}`").cast("string").alias(text))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema)

    def clean(row: str | None, coder: tiktoken.Encoding) -> str | None:
        if not row:
            return row
        at, parts = 0, []
        for start, end in covered(sorted(base_spans(row) + dense_spans(row, coder, least))):
            parts += [row[at:start], mark]
            at = end
        return "".join([*parts, row[at:]])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = vocabulary(path, pattern)
        made = [clean(row, coder) for row in batch.column(len(others)).to_pylist()]
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(made, pa.string())], names=batch.schema.names)

    return by_batch(source, run, fields).select(*[f"`{c}`" for c in docs.columns])
