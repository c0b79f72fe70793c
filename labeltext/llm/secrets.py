"""Secret scan by token efficiency.

Three patterns give the base spans (assignments, access keys, long hex runs). The method adds
random strings that no pattern names: a tokenizer's vocabulary is made of what is written
often, so ordinary words take few tokens for their length and random strings take many.
Candidates are runs of key characters with letters and digits; those with few characters per
token are reported, unless they are known to be harmless: digests of the common lengths (alone
they are no secrets; the hex pattern reports them anyway), UUIDs, and identifiers made of
words, numbers, dates or versions joined by separators. Words of a path or a compound name
would outweigh a key joined to them, so a run that isn't reported whole is searched for the
stretches of tokens that are short by a stricter measure, and those are reported. Short runs
are judged in that way only.

Spans count code points, end exclusive. Null text has no spans. Every row is judged by itself,
whatever its ``doc_id``; other columns are ignored."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import DataFrame

from labeltext.llm.shared import releasing

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# How the vocabulary's tokenizer cuts text before merging (fixed value).
PIECES = (
    r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Random base-64 text has about 1.4 characters per token, random hex 1.7, words over 3.
CHARS_PER_TOKEN = 2.1
SHORTEST, LONGEST_CUT = 20, 4096
# Stretches within a run, and runs below SHORTEST, from SHORTEST_PART characters on. One needs a
# part of LEAST_MIXED characters that is no word or number; its ends move up to EDGE characters
# to the ends of their parts, as a key's first and last tokens may be long.
PART_CHARS_PER_TOKEN = 1.9
SHORTEST_PART, LEAST_MIXED, EDGE = 16, 8, 8

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % SHORTEST_PART)
DIGEST = re.compile(r"(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128})")
UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
IDENTIFIER = re.compile(r"(?:[A-Za-z]+[0-9]{0,4}|[0-9]+)(?:[-_/=+.](?:[A-Za-z]*[0-9]{0,4}|[0-9]+))*")
HARMLESS = re.compile(rf"(?<![A-Za-z0-9])(?:{UUID.pattern}|{DIGEST.pattern})(?![A-Za-z0-9])")
PART, WORDS = re.compile(r"[A-Za-z0-9]+"), re.compile(r"[A-Za-z]+[0-9]{0,4}|[0-9]+")
DIGIT, LETTER = re.compile(r"[0-9]"), re.compile(r"[A-Za-z]")

REDACTED = "[SECRET]"


def _ranks(raw: bytes) -> dict[bytes, int]:
    lines = (line.split() for line in raw.splitlines())
    return {base64.b64decode(token): int(rank) for token, rank in lines}


def _mixed(text: str) -> bool:
    """Whether a part between separators is long and neither a word nor a number."""
    return any(
        m.end() - m.start() >= LEAST_MIXED and not WORDS.fullmatch(m[0]) for m in PART.finditer(text)
    )


def stretches(scores: list[float]) -> list[tuple[int, int]]:
    """All maximal ranges of numbers with a positive sum (Ruzzo and Tompa), in linear time."""
    found: list[tuple[int, int, float, float, int]] = []
    total = 0.0
    for k, score in enumerate(scores):
        low, total = total, total + score
        if score <= 0:
            continue
        start, at = k, len(found) - 1
        while True:
            # The last range that begins at a lower sum.
            while at >= 0 and found[at][2] >= low:
                at = found[at][4]
            if at < 0 or found[at][3] >= total:
                break
            start, _, low, _, before = found[at]
            del found[at:]
            at = before
        found.append((start, k + 1, low, total, at))
    return [(a, b) for a, b, *_ in found]


_ENCODERS: dict[str, object] = {}


class Scanner:
    """Finds the spans of one text. The vocabulary file is read once, on the driver, and sent
    to the tasks as a broadcast of fixed size."""

    def __init__(self, context: SparkContext, vocabulary: str, chars_per_token: float):
        with open(vocabulary, "rb") as file:
            raw = file.read()
        self.name = hashlib.sha256(raw).hexdigest()
        self.raw = context.broadcast(raw)
        self.chars_per_token = chars_per_token

    def encoder(self):
        if self.name not in _ENCODERS:
            import tiktoken

            _ENCODERS[self.name] = tiktoken.Encoding(
                "vocabulary", pat_str=PIECES, mergeable_ranks=_ranks(self.raw.value),
                special_tokens={},
            )
        return _ENCODERS[self.name]

    def lengths(self, text: str) -> list[int]:
        """Characters of each token of an ASCII text."""
        # Merging takes time that grows faster than a piece; long strings are taken in parts.
        parts = [text[k : k + LONGEST_CUT] for k in range(0, len(text), LONGEST_CUT)]
        encoder = self.encoder()
        tokens = encoder.encode_ordinary_batch(parts, num_threads=1)
        return [len(encoder.decode_single_token_bytes(t)) for part in tokens for t in part]

    def random(self, text: str) -> list[tuple[int, int]]:
        """Ranges of a run of key characters that are random."""
        if not DIGIT.search(text) or not LETTER.search(text):
            return []
        if any(p.fullmatch(text) for p in (DIGEST, UUID, IDENTIFIER)):
            return []
        whole, mixed = len(text) >= SHORTEST, _mixed(text)
        if not whole and not mixed:
            return []
        lengths = self.lengths(text)
        if whole and len(text) < self.chars_per_token * len(lengths):
            return [(0, len(text))]
        if not mixed:
            return []
        out, done = [], 0
        for m in HARMLESS.finditer(text):
            out += self.within(text, done, m.start())
            done = m.end()
        return out + self.within(text, done, len(text), None if done else lengths)

    def within(self, text: str, start: int, end: int, lengths: list[int] | None = None):
        """The random stretches of a run from ``start`` to ``end``."""
        if end - start < SHORTEST_PART or not _mixed(text[start:end]):
            return []
        lengths = self.lengths(text[start:end]) if lengths is None else lengths
        places = [start]
        for size in lengths:
            places.append(places[-1] + size)
        # A caller's lower measure holds for stretches too.
        most = min(self.chars_per_token, PART_CHARS_PER_TOKEN)
        out: list[tuple[int, int]] = []
        for a, b in stretches([most - size for size in lengths]):
            a, b = places[a], places[b]
            while a < b and not text[a].isalnum():
                a += 1
            while b > a and text[b - 1] in "/-_+":
                b -= 1
            left = next((k for k in range(a, max(start, a - EDGE) - 1, -1) if k == start or not text[k - 1].isalnum()), a)
            right = next((k for k in range(b, min(end, b + EDGE) + 1) if k == end or not text[k].isalnum()), b)
            part = text[left:right]
            if len(part) < SHORTEST_PART or not _mixed(part) or IDENTIFIER.fullmatch(part):
                continue
            if DIGIT.search(part) and LETTER.search(part):
                if out and left < out[-1][1]:
                    left = out.pop()[0]
                out.append((left, right))
        return out

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(start, kind, end) in order, ``kind`` an index into KINDS."""
        found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
        found += [
            (m.start() + a, 3, m.start() + b)
            for m in CANDIDATE.finditer(text)
            for a, b in self.random(m[0])
        ]
        return sorted(found)


def _line(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def find_secrets(
    docs: DataFrame, vocabulary: str = VOCABULARY, chars_per_token: float = CHARS_PER_TOKEN
) -> DataFrame:
    """Per row: doc_id, counts of the base kinds, base_sha256, spans (of all kinds), n_random."""
    scanner = Scanner(docs.sparkSession.sparkContext, vocabulary, chars_per_token)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[], [], [], []]
            digest, lines = [], []
            for text in batch.column("text"):
                spans = scanner.spans(text.as_py() or "")
                for kind, column in enumerate(counts):
                    column.append(sum(s[1] == kind for s in spans))
                base = _line([s for s in spans if s[1] < 3])
                digest.append(hashlib.sha256(base.encode()).hexdigest())
                lines.append(_line(spans))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    *(pa.array(c, pa.int64()) for c in counts[:3]),
                    pa.array(digest, pa.string()),
                    pa.array(lines, pa.string()),
                    pa.array(counts[3], pa.int64()),
                ],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        releasing(scan),
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
        "spans string, n_random long",
    )


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with every run of overlapping spans replaced by one mark."""
    out, done = [], 0
    for start, _, end in spans:
        if start >= done:
            out += [text[done:start], REDACTED]
        done = max(done, end)
    return "".join([*out, text[done:]])


def redact_secrets(
    docs: DataFrame, vocabulary: str = VOCABULARY, chars_per_token: float = CHARS_PER_TOKEN
) -> DataFrame:
    """``docs`` with its columns, secrets in ``text`` replaced by a mark and ``n_chars``, if there
    is such a column, brought up to date in its own type; texts without secrets, null ones too,
    stay as they are."""
    scanner = Scanner(docs.sparkSession.sparkContext, vocabulary, chars_per_token)
    names = docs.columns

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = names.index("text")
            texts = batch.column(at).to_pylist()
            size_at = names.index("n_chars") if "n_chars" in names else None
            sizes = [None] * len(texts) if size_at is None else batch.column(size_at).to_pylist()
            for k, text in enumerate(texts):
                if text and (spans := scanner.spans(text)):
                    texts[k] = redact(text, spans)
                    sizes[k] = len(texts[k])
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.column(at).type)
            if size_at is not None:
                kind = batch.column(size_at).type
                columns[size_at] = pa.array([str(n) if pa.types.is_string(kind) and n is not None else n for n in sizes], kind)
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(releasing(clean), docs.schema)
