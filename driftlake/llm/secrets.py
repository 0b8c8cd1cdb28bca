"""Secret scans: fixed patterns, and strings that dictionary-primed zstandard cannot shorten.

The base patterns give the kinds ``assign``, ``access`` and ``hex``.  The method adds the
kind ``novel``: a token-like string (twenty characters or more, of mixed kinds, dots included) that follows a sensitive word is a candidate, and its
novelty is how many bytes it adds when it is compressed after the text around it, by
zstandard primed with a dictionary of common identifiers.  Words, paths, identifiers and
repeated strings cost few bytes for their length; random keys cost most of theirs.

Every text is searched whole, row by row, without a shuffle; only a candidate's
surroundings are compressed.  Candidates inside a base span are not reported twice.

Defined results: null and empty texts have no spans (the digest is that of the empty
string).  Positions are code points, ends exclusive.  Repeated rows each get a row.
Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from functools import lru_cache
from itertools import accumulate

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlake.llm.common import given

#: The base patterns and their shortest matches.
KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
SHORTEST_ASSIGNED = 12
#: Runs are taken whole, so the least length can stand in the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")

#: What a candidate must follow, how far before it, and the candidate itself.
SENSITIVE = re.compile(
    r"(?:key|secret|token|passw|pwd|auth|bearer|credential|private|signature|salt|cookie|session)", re.IGNORECASE
)
REACH = 40
SHORTEST_NOVEL = 20
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{20,}", re.ASCII)
#: Keys mix kinds of characters as words, paths and identifiers do not: letters and digits, or
#: a capital after a small letter at one in so many characters.
CAPITAL, CAPITAL_EVERY = re.compile(r"[a-z][A-Z]"), 6
#: Characters of text on each side that prime the compressor, besides the dictionary.
AROUND = 2000
#: A candidate is reported if each of its characters adds at least this many bytes.  So short a
#: string is hardly entropy-coded: random ones add 0.8 to 1.5, identifiers 0.5 to 0.9.
NOVEL = 0.8

#: Common identifiers and words of code.
IDENTIFIERS = (
    "import from class def return self function const let var public private static void string int "
    "boolean true false null none undefined new this super extends implements interface package module "
    "require export default async await promise request response session cookie header content length "
    "authorization bearer basic username password passwd secret token access refresh client server config "
    "settings environment production development localhost http https www example com org net index html "
    "application json text plain charset utf encoding base64 sha256 md5 digest signature certificate begin "
    "end rsa private public key ssh aws amazon google azure bucket region endpoint database connection "
    "string host port user admin root test sample placeholder changeme your_api_key_here xxxxxxxxxxxxxxxx "
    "0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 1234567890 deadbeef 00000000 ffffffff "
    "get set add remove update delete insert select where order group limit offset count total value name "
    "type size list map array object item element node parent child left right top bottom width height "
    "get_value set_value user_id session_id access_token refresh_token client_id client_secret api_key "
    "created_at updated_at file_name path_to_file version number timestamp message error warning debug info"
)


@lru_cache(maxsize=4)
def _compressor(identifiers: str) -> zstandard.ZstdCompressor:
    primed = zstandard.ZstdCompressionDict(identifiers.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=9, dict_data=primed, write_content_size=False, write_checksum=False)


def novelty(text: str, start: int, end: int, identifiers: str = IDENTIFIERS) -> float:
    """Bytes that ``text[start:end]`` adds after its surroundings, for each of its characters."""
    squeeze = _compressor(identifiers).compress
    near = (text[max(0, start - AROUND) : start] + "\n" + text[end : end + AROUND] + "\n").encode()
    candidate = text[start:end].encode()
    return (len(squeeze(near + candidate)) - len(squeeze(near))) / len(candidate)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``start, kind number, end`` of the base matches, in order."""
    spans = []
    if ":" in text or "=" in text:
        spans += [
            (m.start(), 0, m.end())
            for m in ASSIGN.finditer(text)
            if m.end(2) - m.start(2) >= SHORTEST_ASSIGNED
        ]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def _mixed(candidate: str) -> bool:
    letters, digits = (any(map(kind, candidate)) for kind in (str.isalpha, str.isdigit))
    return letters and (digits or len(CAPITAL.findall(candidate)) * CAPITAL_EVERY >= len(candidate))


def novel_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Incompressible strings in sensitive surroundings that no base span covers."""
    found = []
    starts = [start for start, _, _ in base]
    reach = list(accumulate((end for _, _, end in base), max))
    for match in CANDIDATE.finditer(text):
        start, end = match.start(), match.start() + len(match[0].rstrip("."))
        if end - start < SHORTEST_NOVEL or not _mixed(text[start:end]):
            continue
        before = bisect_left(starts, end)
        if before and reach[before - 1] > start:
            continue
        if SENSITIVE.search(text, max(0, start - REACH), start) and novelty(text, start, end) >= NOVEL:
            found.append((start, 3, end))
    return found


def spelled(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def _scan(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        text = text or ""
        base = base_spans(text)
        counts = [sum(kind == k for _, kind, _ in base) for k in range(3)]
        every = sorted(base + novel_spans(text, base))
        rows.append((*counts, hashlib.sha256(spelled(base).encode()).hexdigest(), spelled(every)))
    return pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def scan_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` for every row of ``docs``."""
    scan = F.pandas_udf(_scan, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    return docs.select("doc_id", scan("text").alias("found")).select("doc_id", "found.*")


def op6_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return scan_secrets(given(spark, folder, "documents"))
