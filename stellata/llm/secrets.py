"""Secret scans: an Aho-Corasick keyword prefilter, regular expressions anchored at its
hits only, then checksums that some tokens carry.

Texts are scanned as UTF-8 bytes with A-Z lower-cased (lengths stay), all patterns being
ASCII; places are turned into code points at the end.
"""

from __future__ import annotations

import re
import zlib
from itertools import product

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellata.llm.common import col, numbered, text_of

BASE = ("assign", "access", "hex")
#: Kinds that the method adds: tokens whose last six characters are a checksum.
CHECKED = ("github", "npm")
KINDS = BASE + CHECKED
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

#: kind -> (keywords in lower case, pattern that must match where a keyword starts)
_SPECS = {
    "assign": (("password", "passwd", "secret", "token", "api_key", "apikey"),
               rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": (("akia",), rb"AKIA[A-Z0-9]+"),
    # every run of four or more has its first four characters among these
    "hex": (tuple(map("".join, product("0123456789abcdef", repeat=4))), rb"[0-9a-f]+"),
    "github": (("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), rb"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
    "npm": (("npm_",), rb"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
}


def checksum(body: bytes) -> bytes:
    """CRC-32 as six digits to the base 62, as such tokens carry it."""
    value, out = zlib.crc32(body), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        out = _BASE62[digit] + out
    return out.encode()


def _accept(kind: str, match: re.Match) -> bool:
    if kind == "assign":
        return len(match[1]) >= 6
    if kind == "access":
        return len(match[0]) >= 20
    if kind == "hex":
        return len(match[0]) >= 24
    return checksum(match[1][:30]) == match[1][30:]


class Scanner:
    """All kinds in one automaton; ``spans(text)`` gives (kind, start, end), by start,
    then in the order of the kinds."""

    def __init__(self):
        self.automaton = ahocorasick.Automaton()
        for i, kind in enumerate(KINDS):
            for word in _SPECS[kind][0]:
                self.automaton.add_word(word, (i, len(word)))
        self.automaton.make_automaton()
        self.patterns = [re.compile(_SPECS[k][1], re.ASCII | (re.IGNORECASE if k == "assign" else 0)) for k in KINDS]

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        data = text.encode()
        found, done = [], [0] * len(KINDS)
        for last, (kind, length) in self.automaton.iter(data.lower().decode("latin-1")):
            start = last + 1 - length
            if start < done[kind]:
                continue  # inside the match before: matches of a kind do not overlap
            match = self.patterns[kind].match(data, start)
            if match:
                done[kind] = match.end()
                if _accept(KINDS[kind], match):
                    found.append((start, kind, match.end()))
        found.sort()
        if len(data) == len(text):
            return [(KINDS[k], s, e) for s, k, e in found]
        points, at, n = {}, 0, 0
        for place in sorted({x for s, _, e in found for x in (s, e)}):
            n += len(data[at:place].decode())
            points[place], at = n, place
        return [(KINDS[k], points[s], points[e]) for s, k, e in found]


_SCANNER: list[Scanner] = []


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row, id and spans (array of kind, start, end: code points, end exclusive) per
    document.

    Matches of one kind are leftmost and do not overlap; those of different kinds may.
    ``assign`` needs a value of 6 characters, ``access`` 20 in all, ``hex`` 24; ``github``
    and ``npm`` tokens need the right checksum. Null and empty texts have no spans.
    Repeated rows and null ids are rows like any other; an empty table gives no rows;
    other columns are ignored. One pass without a shuffle.
    """
    rows = numbered(docs, id=col(id_col), text=text_of(text_col))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        if not _SCANNER:
            _SCANNER.append(Scanner())
        scanner = _SCANNER[0]
        for batch in batches:
            spans = [[{"kind": k, "start": s, "end": e} for k, s, e in scanner.spans(x.as_py())]
                     for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), pa.array(spans, kind)],
                                             names=["row", "id", "spans"])

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"row long, id {id_type}, spans array<struct<kind:string,start:long,end:long>>")


def report(found: DataFrame) -> DataFrame:
    """id, n_assign, n_access, n_hex, base_sha256 and spans (text) from ``scan``."""
    said = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return found.select("id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE],
                        F.sha2(said(of(*BASE)), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"))
