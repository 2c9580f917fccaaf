"""Secrets: fixed forms, and strings that a dictionary-primed compressor finds new.

Fixed forms are matched in the text as it stands and always stay. Beside them, a string
that stands in a sensitive context is measured: its marginal compressed bytes, the
zstandard size of the surroundings with it less the size without it, by a compressor
primed with a dictionary of the corpus's identifiers. Names, paths and words are
mostly known to the dictionary or the surroundings and cost a fraction of a byte a
character; keys and passwords do not compress. A string whose marginal bytes are
``NOVELTY`` of its length or more is reported as kind ``novel``, unless it equals or lies inside a
span of a fixed form.

* Candidates: strings of ``[A-Za-z0-9+/_.~-]`` of ``SHORTEST`` characters or more (with ``=`` behind) that
  start within ``REACH`` characters behind a sensitive word, on its line.
* Surroundings: ``AROUND`` characters on each side, without copies of the string itself.
* Dictionary: the parts of identifiers (``getUserName``: get, User, Name) of 3 to 12 letters, counted
  by document over all documents, as many as fill ``DICTIONARY`` bytes in order of documents times
  length; the most frequent stand last, nearest to the text. A secret of many copies cannot
  enter it whole, having digits or more letters. The size of the dictionary is a
  property of the model, like a compressor's window: it bounds no scan and drops no
  candidate.

The time is in proportion to the text: every text is scanned once a form, and every
candidate measured once over a bounded stretch besides itself.

Cases: null and empty texts have no spans; texts of any length are scanned whole;
repeated rows are handled each for itself; a row without a doc_id is handled like any
other; parts of equal weight enter the dictionary in alphabetical order; an empty table
gives no rows; extra columns are ignored by ``detect`` and kept by ``redact``.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import cut, texts

#: Kinds in the order in which spans with equal starts are listed; the first three are the fixed forms.
KINDS = ["assign", "access", "hex", "novel"]

# the forms (fixed values); letters of the names in either case, ASCII only
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ASSIGN_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")

#: Words that make a context sensitive (fixed values): the first anywhere, also inside names, the
#: second as a part of a name of their own (``api_key``, ``apiKey``, not ``monkey``).
_ANYWHERE = ["password", "passwd", "passphrase", "secret", "token", "credential", "authorization", "bearer", "private",
             "signature", "cookie", "session", "passwort", "kennwort", "schlüssel", "geheimnis", "contraseña", "mot de passe",
             "jeton", "clave"]
_AS_PART = ["key", "pass", "pwd", "auth", "salt", "jwt", "cred", "creds", "pin", "login", "sig", "hmac"]
_SENSITIVE = re.compile("(?i:" + "|".join(_ANYWHERE) + r")|(?<![A-Za-z])(?i:" + "|".join(_AS_PART) + r")(?![a-z])|(?:"
                        + "|".join(w.capitalize() for w in _AS_PART) + ")(?![a-z])")
_LITERALS = (*_ANYWHERE, *_AS_PART)

SHORTEST, REACH, AROUND = 12, 64, 256
_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_.~-]{{{SHORTEST},}}={{0,2}}")
_RUN = re.compile("[A-Za-z0-9+/_.~-]*")
NOVELTY = 0.95
DICTIONARY, LEVEL = 65_536, 9

_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
#: Different parts that a task counts before it hands them on.
_HELD = 200_000

Span = tuple[int, int, str]


def fixed_spans(t: str) -> list[Span]:
    """Matches of the fixed forms, by start, then kind."""
    found: list[Span] = []
    low = t.lower()
    if any(w in low for w in _ASSIGN_NAMES):
        found += [(*m.span(), "assign") for m in _ASSIGN.finditer(t) if len(m.group(2)) >= 8]
    if "AKIA" in t:
        found += [(*m.span(), "access") for m in _ACCESS.finditer(t)]
    found += [(*m.span(), "hex") for m in _HEX.finditer(t)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def candidates(t: str) -> Iterator[tuple[int, int]]:
    """Strings in sensitive contexts, each once, from left to right."""
    low = t.lower()
    if not any(w in low for w in _LITERALS):
        return
    done = 0
    for m in _SENSITIVE.finditer(t):
        if m.end() + REACH <= done:
            continue  # its reach lies inside a string already taken
        line = t.find("\n", m.end(), m.end() + REACH)
        stop = m.end() + REACH if line < 0 else line
        if m.end() > done:
            # a string that the word itself runs into, such as token_store, is not taken from its middle
            done = _RUN.match(t, m.end()).end()
        # to find where a string starts, a bounded stretch is enough; its end may lie anywhere
        while done < stop and (c := _CANDIDATE.search(t, done, stop + SHORTEST - 1)):
            whole = _CANDIDATE.match(t, c.start())
            yield whole.span()
            done = whole.end()


class Novelty:
    """Marginal compressed sizes under a dictionary."""

    def __init__(self, dictionary: bytes):
        primed = None
        if len(dictionary) >= 8:
            primed = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            primed.precompute_compress(level=LEVEL)
        self.zstd = zstandard.ZstdCompressor(level=LEVEL, dict_data=primed, write_content_size=False, write_checksum=False,
                                             write_dict_id=False)

    def marginal(self, t: str, a: int, b: int) -> int:
        own = t[a:b]
        before, after = t[max(0, a - AROUND): a].replace(own, ""), t[b: b + AROUND].replace(own, "")
        alone = len(self.zstd.compress((before + after).encode()))
        return len(self.zstd.compress((before + own + after).encode())) - alone


def all_spans(t: str, novelty: Novelty) -> tuple[list[Span], list[Span]]:
    """Spans of the fixed forms, and these with the novel ones, each by start, then kind."""
    fixed = fixed_spans(t)
    starts, ends, far = [], [], 0
    for a, b, _ in fixed:
        far = max(far, b)
        starts.append(a)
        ends.append(far)
    new = []
    for a, b in candidates(t):
        k = bisect_right(starts, a) - 1  # of the fixed spans that start by a, does one reach b
        if (k < 0 or ends[k] < b) and novelty.marginal(t, a, b) >= NOVELTY * (b - a):
            new.append((a, b, "novel"))
    return fixed, sorted([*fixed, *new], key=lambda s: (s[0], KINDS.index(s[2])))


def identifier_parts(docs: DataFrame) -> DataFrame:
    """(part, documents): the parts of identifiers and the number of documents with each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                              ["part", "n"])
            held.clear()
            return rows

        for b in batches:
            for t in b.column("text"):
                held.update({p for p in _PART.findall(t.as_py()) if 3 <= len(p) <= 12})
                if len(held) >= _HELD:
                    yield out()
        if held:
            yield out()

    return texts(docs).mapInArrow(run, "part string, n long").groupBy("part").agg(F.sum("n").alias("documents"))


def dictionary(docs: DataFrame, size: int = DICTIONARY) -> bytes:
    """The identifier dictionary of the corpus: at most ``size`` bytes, so the driver holds at most
    ``size`` / 4 parts, as a part has three letters and a space or more."""
    weight = F.col("documents") * F.length("part")
    counted = cut(identifier_parts(docs).where("documents > 1").withColumn("weight", weight), "secrets-parts")
    # bytes by steps of the weight's logarithm (a few hundred rows) tell below which weight no part has
    # room, so that the sort sees little more than the dictionary
    steps = (counted.groupBy(F.floor(F.log2("weight") * 8).alias("step")).agg(F.sum(F.length("part") + 1).alias("bytes"))
             .orderBy(F.desc("step")).collect())
    least, room = None, size
    for r in steps:
        least, room = r.step, room - r.bytes
        if room < 0:
            break
    rows = (counted.where(F.floor(F.log2("weight") * 8) >= F.lit(least)).orderBy(F.desc("weight"), "part").limit(size // 4)
            .select("part").collect())
    parts, used = [], 0
    for r in rows:
        used += len(r.part) + 1
        if used > size:
            break
        parts.append(r.part)
    return " ".join(reversed(parts)).encode()


def _join(spans: list[Span]) -> str:
    return ",".join([f"{k}:{a}:{b}" for a, b, k in spans])


def detect(docs: DataFrame, known: bytes | None = None) -> DataFrame:
    """(doc_id, base, spans): the spans of the fixed forms and all spans of each document, each as
    ``kind:start:end`` joined by commas; code points, end exclusive. ``known`` is the
    dictionary, made from ``docs`` if not given."""
    primed = dictionary(docs) if known is None else known

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(primed)
        for b in batches:
            found = [all_spans(t.as_py(), novelty) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([_join(p) for p, _ in found], pa.string()),
                 pa.array([_join(x) for _, x in found], pa.string())], ["doc_id", "base", "spans"])

    return texts(docs).mapInArrow(run, "doc_id long, base string, spans string")


def mask(t: str | None, novelty: Novelty) -> str | None:
    """The text with every span replaced by its kind in angle brackets; overlapping spans are
    replaced as one, by the kind of the first."""
    if not t:
        return t
    out, at = [], 0
    for a, b, kind in all_spans(t, novelty)[1]:
        if a >= at:
            out += [t[at:a], f"<{kind}>"]
        at = max(at, b)
    return "".join([*out, t[at:]]) if out else t


def redact(docs: DataFrame, known: bytes | None = None) -> DataFrame:
    """The same rows and columns with the secrets in ``text`` masked."""
    primed = dictionary(docs) if known is None else known
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(primed)
        for b in batches:
            yield b.set_column(place, b.schema.field(place), pa.array(
                [mask(t.as_py(), novelty) for t in b.column(place)], b.schema.field(place).type))

    return docs.mapInArrow(run, docs.schema)


def secrets_digest(docs: DataFrame) -> DataFrame:
    """Counts by fixed form, checksum of their spans, and all spans; ``n_novel`` counts the added ones."""
    found = detect(docs)

    def count(kind: str):
        return F.regexp_count("spans", F.lit(f"{kind}:")).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in KINDS[:3]], F.sha2("base", 256).alias("base_sha256"), "spans", count("novel"))
