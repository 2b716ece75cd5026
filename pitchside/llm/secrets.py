"""Secret scan: fixed patterns, and dictionary-primed zstandard novelty.

Besides three base patterns, tokens of 16 or more secret-like characters near a sensitive
word are candidates: on its line, before or after it, on the two lines that follow it, or in the
block of a private key. Sensitive words stand at word borders (of camelCase too).

A candidate's novelty is the number of compressed bytes it adds, as a share of its length.
zstandard is primed with a dictionary that is trained on code (identifiers, calls and messages
of the standard library), so names, paths and prose cost about half a byte a character, and a
random string nearly a whole one. It is measured with nothing else, after the text before it,
after the text behind it, and after both; the least counts. Other places of the
same token are taken out of the surroundings first, so that a secret which stands twice is found
twice. Dates in a token, the case of capitals and camelCase, and the separators of names do not count, and a token must change
between small, capital letters and digits at least once in eight characters. Candidates that add
at least ``min_bytes`` and ``min_ratio`` are reported as kind ``novel``.

Edge cases: a null or empty text has no spans. Texts are scanned whole, whatever their length. Each
row is judged alone, so repeated rows get the same result. No exchange takes place.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchside.llm import kernels as K
from pitchside.llm.common import identified, public_id

KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
# runs below the required length cannot hold a longer match, so the bound is in the pattern
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
SENSITIVE = re.compile(
    r"(?:(?<![A-Za-z])|(?<=[a-z])(?=[A-Z]))(?i:passw(?:or)?ds?|passphrases?|pwd|secrets?|tokens?|(?:api|access|auth|secret|private|signing|encryption)[_-]?keys?|keys?|auth|authorization|credentials?|creds?|bearer|private)(?![a-z])",
    re.ASCII,
)
KEY_BLOCK = re.compile(r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY[A-Z ]{0,10}-----")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
DATE = re.compile(r"[12][0-9]{3}[-_/]?[01][0-9][-_/]?[0-3][0-9](?:[T_-]?[0-2][0-9][-:_]?[0-5][0-9](?:[-:_]?[0-5][0-9])?)?")
CHANGE = re.compile(r"(?<=[a-z])[A-Z0-9]|(?<=[A-Z])[a-z0-9]|(?<=[0-9])[A-Za-z]")
CAMEL = re.compile(r"[A-Z]?[a-z]{2,}")
NAME = re.compile(r"(?:[A-Za-z][a-z]++|[0-9]{1,4}+(?![0-9])|[/_-])++(?<=[a-z0-9])")  # possessive: one way to match
SEPARATOR = re.compile(r"[/_-]+")
BORDER = re.compile(r"(?<=[a-z])(?=[A-Z])")
# fixed values: modules of the standard library whose source the dictionary is trained on
CODE = (
    "argparse", "ast", "calendar", "collections", "configparser", "csv", "datetime", "email.message", "ftplib", "http.client", "http.cookies",
    "imaplib", "inspect", "json.decoder", "logging", "logging.handlers", "mailbox", "os", "pathlib", "pickle", "random", "shutil", "smtplib",
    "socket", "ssl", "string", "subprocess", "tarfile", "tempfile", "threading", "unittest.case", "urllib.parse", "urllib.request", "uuid", "zipfile",
)
DICTIONARY_BYTES = 64 << 10


@dataclass(frozen=True)
class Novelty:
    context: int = 256  # characters on either side of the candidate
    reach: int = 64  # characters between the sensitive word and the candidate
    lines: int = 2  # line breaks after the word that the reach may cross
    block: int = 8192  # characters of a private key's block
    min_bytes: int = 10
    min_ratio: float = 0.68


@functools.cache
def code_dictionary(size: int = DICTIONARY_BYTES, modules: tuple[str, ...] = CODE) -> bytes:
    """A zstandard dictionary trained on the source of modules, four lines a sample."""
    import importlib
    import inspect

    import zstandard

    samples = []
    for name in modules:
        lines = [x.strip() for x in inspect.getsource(importlib.import_module(name)).split("\n") if x.strip()]
        samples += ["\n".join(lines[i : i + 4]).encode() for i in range(0, len(lines), 4)]
    return zstandard.train_dictionary(size, samples, level=19).as_bytes()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the base matches, leftmost non-overlapping per kind."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def sensitive_zones(text: str, conf: Novelty) -> list[tuple[int, int]]:
    """Merged ranges in which a candidate has to begin, in order."""
    zones = []
    for m in SENSITIVE.finditer(text):
        a, b = m.span()
        start = max(a - conf.reach, text.rfind("\n", 0, a) + 1)
        # a token that ends within the reach may begin earlier
        while start > 0 and text[start - 1] != "\n" and CANDIDATE.match(text, start) is None and text[start - 1] not in " \t\"'`" and a - start < 4 * conf.reach:
            start -= 1
        end = min(b + conf.reach, len(text))
        at = b - 1
        for _ in range(conf.lines + 1):
            if (at := text.find("\n", at + 1, end)) < 0:
                break
        zones.append((start, end if at < 0 else at))
    for m in KEY_BLOCK.finditer(text):
        end = text.find("-----END", m.end(), m.end() + conf.block)
        zones.append((m.end(), end if end >= 0 else min(len(text), m.end() + conf.block)))
    out: list[tuple[int, int]] = []
    for a, b in sorted(zones):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def novelty(text: str, start: int, end: int, conf: Novelty, marginal) -> tuple[int, int]:
    """(compressed bytes that a token adds at least, its length without dates)."""
    raw = text[start:end]
    token = DATE.sub("", raw)
    if token.isupper():
        token = token.lower()
    if NAME.fullmatch(token):
        token = SEPARATOR.sub(" ", token)
    if 10 * sum(map(len, CAMEL.findall(token))) >= 8 * sum(map(str.isalpha, token)):
        token = BORDER.sub(" ", token).lower()  # words of camelCase
    before = text[max(0, start - conf.context) : start].replace(raw, "")
    after = text[end : end + conf.context].replace(raw, "")
    surroundings = ("", before, after + " ", f"{after}\n{before}")
    return min(marginal(x.encode(), token.encode()) for x in surroundings), len(token)


def novel_spans(text: str, conf: Novelty, marginal) -> list[tuple[int, int, int]]:
    """Candidates in a sensitive context that add nearly their length to their surroundings."""
    out, done = [], 0
    for a, b in sensitive_zones(text, conf):
        for m in CANDIDATE.finditer(text, max(a, done)):
            start, end = m.span()
            if start > b:
                break
            done = end
            n_changes = len(CHANGE.findall(text, start, end))
            if n_changes < (end - start) // 8 or not any(c.isalpha() for c in m[0]):
                continue
            added, n = novelty(text, start, end, conf, marginal)
            if added >= conf.min_bytes and added >= conf.min_ratio * n:
                out.append((start, 3, end))
    return out


def marginal_bytes(dictionary: bytes, level: int = 19):
    """marginal(context, token): compressed bytes the token adds after its context."""
    import zstandard

    zd = zstandard.ZstdCompressionDict(dictionary)
    zd.precompute_compress(level=level)
    c = zstandard.ZstdCompressor(level=level, dict_data=zd, write_content_size=False, write_checksum=False, write_dict_id=False)
    return lambda context, token: len(c.compress(context + token)) - len(c.compress(context))


def _show(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame, conf: Novelty = Novelty(), dictionary: bytes | None = None) -> DataFrame:
    """Per row: _id, counts of each base kind, the base spans and all spans as text.

    ``dictionary``: a trained zstandard dictionary (``code_dictionary`` without one); it is sent to the
    tasks, ``DICTIONARY_BYTES`` long."""
    sent = docs.sparkSession.sparkContext.broadcast(code_dictionary() if dictionary is None else dictionary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marginal = marginal_bytes(sent.value)
        for b in K.slices(batches):
            counts, base, every = ([], [], []), [], []
            for text in b.column(1).to_pylist():
                text = text or ""
                found = base_spans(text)
                for k in range(3):
                    counts[k].append(sum(x[1] == k for x in found))
                base.append(_show(found))
                every.append(_show(sorted(found + novel_spans(text, conf, marginal))))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(base, pa.string()), pa.array(every, pa.string())],
                ["_id", "n_assign", "n_access", "n_hex", "base", "spans"],
            )

    return identified(docs).mapInArrow(work, "_id long, n_assign long, n_access long, n_hex long, base string, spans string")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return scan(docs).select(public_id(), "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans")
