"""Secret scans by patterns and by dictionary-primed zstandard novelty.

Three patterns give the base spans: assigned values, access keys and long hexadecimal runs. Beside them, a run of token
characters that mixes letters and digits and stands close behind a sensitive word is a candidate. Its novelty is the number
of bytes by which it lengthens the compressed form of the text around it, under a compressor primed with a dictionary of
identifiers: what names, words and repeated code explain adds little, a random key adds nearly all its information. A
candidate that no base span touches is reported (kind novel) when each of its characters adds `least_rate` bytes or more.
Where a candidate stands again in the text around it, those places are left out of that text, so a key that is used twice is as
novel as one that is used once.

Texts are judged one by one, in one narrow pass, whole; only the window around a candidate is compressed.

Nulls: a null text is empty and has no spans; rows with a null id, repeated rows and rows of one id keep a row each; an
empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import bisect
import functools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text

KINDS = ("assign", "access", "hex", "novel")

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
#: Runs are taken whole and short ones dropped, so the least lengths may stand in the patterns.
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGNED = 8

WORDS = ("key", "token", "secret", "passw", "passphrase", "pwd", "auth", "bearer", "credential", "private", "signature", "cookie", "session", "webhook")
SENSITIVE = re.compile("|".join(WORDS), re.IGNORECASE | re.ASCII)
RUN = re.compile(r"[A-Za-z0-9+/_=-]+")
_DIGIT, _LETTER = re.compile("[0-9]"), re.compile("[A-Za-z]")

#: Names that stand in code and configuration around secrets without being any.
IDENTIFIERS = (
    "access_key_id aws_access_key_id aws_secret_access_key api_key api_key_id api_token apikey app_id application/json auth_token authentication authorization base64 basic_auth bearer_token "
    "bucket certificate client_id client_secret config configuration connection_string content_type cookie credentials csrf_token database_url default development docker encryption_key "
    "environment example example_key export filename function getElementById github_token hostname http:// https:// identifier import insert_your_key_here javascript kubernetes license_key localhost "
    "master_key max_tokens message namespace new_token next_token null number object oauth2 openssl options page_token parameter passphrase password password123 path placeholder port private_key "
    "process.env production project_id public_key publickey python redis refresh_token register replace_me request response return rsa_private_key schema secret_key secretmanager select "
    "self.token service_account session_id session_token sha256 sha512 signature_version signing_key ssh-ed25519 ssh-rsa string table template test_key test_token timestamp token_type tokenizer "
    "undefined update username utf-8 uuid validate value variable version webhook_secret x-api-key xxxxxxxxxxxxxxxx your_api_key your_token_here 0123456789 1234567890 abcdefghijklmnopqrstuvwxyz 0123456789abcdef"
)


class Novelty:
    """Marginal compressed bytes under a compressor primed with identifiers."""

    def __init__(self, identifiers: str = IDENTIFIERS, level: int = 9):
        import zstandard

        primed = zstandard.ZstdCompressionDict(identifiers.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.compressor = zstandard.ZstdCompressor(level=level, dict_data=primed, write_content_size=False, write_checksum=False, write_dict_id=False)

    def size(self, text: str) -> int:
        return len(self.compressor.compress(text.encode("utf-8", "surrogatepass")))

    def marginal(self, candidate: str, around: str) -> int:
        return self.size(f"{around}\n{candidate}") - self.size(f"{around}\n")


@functools.lru_cache(maxsize=8)
def novelty(identifiers: str) -> Novelty:
    return Novelty(identifiers)


def base_spans(text: str, low: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of the patterns' spans; low is the text in lower case, to pass most texts quickly."""
    found = []
    if any(w in low for w in ("passw", "secret", "token", "api")):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGNED]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    return found + [(m.start(), 2, m.end()) for m in HEX.finditer(text)]


def novel_spans(text: str, base: list[tuple[int, int, int]], own: Novelty, least_length: int, least_rate: float, reach: int, around: int) -> list[tuple[int, int, int]]:
    """Spans of candidates that lie within `reach` characters behind a sensitive word, touch no base span and are novel."""
    words = [m.end() for m in SENSITIVE.finditer(text)]
    taken = sorted((a, b) for a, _, b in base)
    latest = list(_running_max(b for _, b in taken))
    starts = [a for a, _ in taken]
    out, looked = [], 0
    for end in words:
        if end + reach < looked:
            continue
        for m in RUN.finditer(text, max(end, looked)):
            if m.start() > end + reach:
                break
            looked = m.end()
            a, b = m.span()
            before = bisect.bisect_left(starts, b)
            if b - a < least_length or (before and latest[before - 1] > a) or not (_DIGIT.search(m[0]) and _LETTER.search(m[0])):
                continue
            window = f"{text[max(0, a - around):a]}\n{text[b : b + around]}".replace(m[0], "")
            if own.marginal(m[0], window) >= least_rate * (b - a):
                out.append((a, 3, b))
    return out


def _running_max(values: Iterator[int]) -> Iterator[int]:
    most = 0
    for v in values:
        most = max(most, v)
        yield most


_SCHEMA = "doc_id long, spans array<struct<kind:string,start:long,end:long,value:string>>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())])


def _scan(identifiers: str, least_length: int, least_rate: float, reach: int, around: int):
    def spans_of(text: str | None) -> list[dict]:
        if not text:
            return []
        low = text.lower()
        base = base_spans(text, low)
        found = base + (novel_spans(text, base, novelty(identifiers), least_length, least_rate, reach, around) if any(w in low for w in WORDS) else [])
        return [{"kind": KINDS[k], "start": a, "end": b, "value": text[a:b]} for a, k, b in sorted(found)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                spans = [spans_of(t.as_py()) for t in part.column("text")]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(spans, pa.list_(_SPAN))], ["doc_id", "spans"])

    return run


def scan_secrets(docs: DataFrame, identifiers: str = IDENTIFIERS, least_length: int = 16, least_rate: float = 0.8, reach: int = 64, around: int = 1000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, spans (kind, start, end, value; by start, then kind) of every row of `docs`; places count code points."""
    return id_text(docs, id_col, text_col).mapInArrow(_scan(identifiers, least_length, least_rate, reach, around), _SCHEMA)


def secret_report(docs: DataFrame, **options) -> DataFrame:
    """Counts and digests of scan_secrets: doc_id, n_assign, n_access, n_hex, n_novel, base_sha256, spans."""
    found = scan_secrets(docs, **options)
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != "novel")
    return found.select("doc_id", *map(n, KINDS), F.sha2(shown(base), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"))
