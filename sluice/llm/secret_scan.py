"""Secret scan with corpus-wide ownership frequency.

Patterns find candidates in every text. A candidate's value is hashed and the hashes are
aggregated over the corpus by distinct owners and distinct repositories: a value in the hands of
many owners is a widely copied example, one that a single owner holds in few repositories looks
live. Values never leave the tasks, only their hashes do.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.rows import map_rows, staged, utf8

KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(
    r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"""
    r"""|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ASSIGN_HINTS = ("passw", "secret", "token", "api")
_ASSIGN_LEAST = 6
# Maximal runs, so asking for the least length here drops the same matches as asking afterwards.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
# Unlabelled candidates that the method adds: long unbroken runs that look random.
_OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}")
OPAQUE_BITS = 3.8
MAX_OWNERS = 1
MAX_REPOSITORIES = 3


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of every base candidate, by start, then by kind as listed."""
    found = []
    lowered = text.lower()
    if any(hint in lowered for hint in _ASSIGN_HINTS):
        for match in _ASSIGN.finditer(text):
            if len(match[1]) >= _ASSIGN_LEAST:
                found.append((match.start(), 0, match.end()))
    found += [(match.start(), 1, match.end()) for match in _ACCESS.finditer(text)]
    found += [(match.start(), 2, match.end()) for match in _HEX.finditer(text)]
    return [(start, KINDS[kind], end) for start, kind, end in sorted(found)]


def value_of(kind: str, found: str) -> str:
    """The credential in a span: of an assignment the right side, else the whole span."""
    return _ASSIGN.match(found)[1] if kind == "assign" else found


def looks_random(value: str) -> bool:
    """Digits and letters of both cases, with entropy per character of ``OPAQUE_BITS`` or more."""
    if not (any(c.isdigit() for c in value) and any(c.islower() for c in value) and any(c.isupper() for c in value)):
        return False
    counts = Counter(value).values()
    return -sum(n / len(value) * math.log2(n / len(value)) for n in counts) >= OPAQUE_BITS


def opaque_spans(text: str, base: list[tuple[int, str, int]]) -> Iterator[tuple[int, str, int]]:
    """Random-looking runs that no base span touches."""
    ends = sorted((start, end) for start, _, end in base)
    at = 0
    for match in _OPAQUE.finditer(text):
        start, end = match.span()
        while at < len(ends) and ends[at][1] <= start:
            at += 1
        if (at == len(ends) or ends[at][0] >= end) and looks_random(match[0]):
            yield start, "opaque", end


def value_hash(value: str) -> bytes:
    return hashlib.sha256(utf8(value)).digest()[:16]


def digest(spans) -> str:
    return hashlib.sha256(",".join(f"{kind}:{start}:{end}" for start, kind, end in spans).encode()).hexdigest()


def candidates(
    documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", owner: str = "source", repository: str = "lang"
) -> DataFrame:
    """One small row per document, without its text: base counts and digest, and the candidates' spans and hashes.

    ``row`` numbers the rows, so repeated ids stay apart; it is only used once this frame is written.
    """

    def work(rows):
        for key, body, held_by, within in rows:
            body = body or ""
            base = base_spans(body)
            spans = sorted([*base, *opaque_spans(body, base)], key=lambda span: span[0])
            counts = Counter(kind for _, kind, _ in base)
            found = [(s, k, e, value_hash(value_of(k, body[s:e])), k != "opaque") for s, k, e in spans]
            yield key, *(counts[kind] for kind in KINDS), digest(base), found, held_by, within

    source = documents.select(
        F.col(doc_id).alias("doc_id"),
        F.col(text).cast("string"),
        # A null owner or repository is an owner or repository of its own name.
        F.coalesce(F.col(owner).cast("string"), F.lit("")),
        F.coalesce(F.col(repository).cast("string"), F.lit("")),
    )
    schema = (
        f"doc_id {source.schema[0].dataType.simpleString()}, n_assign bigint, n_access bigint, n_hex bigint, "
        "base_sha256 string, "
        "found array<struct<start:int,kind:string,end:int,hash:binary,base:boolean>>, owner string, repository string"
    )
    return map_rows(source, work, schema)


def ownership(found: DataFrame) -> DataFrame:
    """``hash, n_owners, n_repositories`` of every candidate value; a repository is one owner's.

    Counting is in two steps, so a value that fills a third of all rows is reduced to its
    distinct (owner, repository) pairs before it is shuffled.
    """
    each = found.select("owner", "repository", F.explode("found.hash").alias("hash"))
    pairs = each.groupBy("hash", "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
    owners = pairs.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repos"), F.sum("n").alias("n"))
    return owners.groupBy("hash").agg(
        F.count(F.lit(1)).alias("n_owners"), F.sum("repos").alias("n_repositories"), F.sum("n").alias("n_seen")
    )


def scan(
    documents: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    owner: str = "source",
    repository: str = "lang",
    max_owners: int = MAX_OWNERS,
    max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """Per document the base digest, all spans, and how many look live or are copied examples.

    Base spans stay whatever their frequency. The method adds ``opaque`` spans: unlabelled
    random-looking values with at most ``max_owners`` owners and ``max_repositories``
    repositories. ``spans`` lists both, ``live`` those that pass the frequency rule. A null text
    is empty: no spans. Null ids, owners and repositories are values like others; repeated rows
    are answered row by row and count as further sightings. Other columns are ignored.
    """
    every = staged(
        candidates(documents, doc_id=doc_id, text=text, owner=owner, repository=repository).withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "secrets",
    )
    some = every.where(F.size("found") > 0)
    known = ownership(some)
    each = some.select("row", F.explode("found").alias("one")).select("row", "one.*")
    owned = (F.col("n_owners") <= max_owners) & (F.col("n_repositories") <= max_repositories)
    judged = each.join(known, "hash").withColumn("live", owned)
    order = F.when(F.col("kind") == "assign", 0).when(F.col("kind") == "access", 1).when(F.col("kind") == "hex", 2)
    spans = (
        judged.where("base or live")
        .groupBy("row")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("start", F.coalesce(order, F.lit(3)).alias("order"), "kind", "end", "live"))
            ).alias("all")
        )
    )
    joined = every.drop("found").join(spans, "row", "left")
    all_spans = F.coalesce("all", F.array().cast("array<struct<start:int,order:int,kind:string,end:int,live:boolean>>"))

    def listed(items):
        return F.array_join(F.transform(items, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    live = F.filter("all", lambda s: s["live"])
    return joined.withColumn("all", all_spans).select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        "base_sha256",
        listed(F.col("all")).alias("spans"),
        listed(live).alias("live"),
        F.size(live).cast("bigint").alias("n_live"),
        (F.size("all") - F.size(live)).cast("bigint").alias("n_examples"),
    )


MASK = "<secret>"


def masked(
    documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", owner: str = "source", repository: str = "lang"
) -> DataFrame:
    """``documents`` with every live-looking value replaced by ``MASK``; copied examples stay.

    The columns, their order and the rows stay. A null text stays null; null owners and repositories are of their own
    name; repeated rows are masked row by row and count as further sightings; an empty table gives an empty
    one. Columns named ``_hashes``, ``_row`` or ``_live`` would clash, so the pipeline renames them meanwhile.
    The texts are not shuffled: the hashes of live
    values are looked up where they are found, by a join on the hash of the few rows that have
    candidates, and only those rows move.
    """
    names = documents.columns
    at = [names.index(name) for name in (text, owner, repository)]
    fields = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in documents.schema)

    def find(rows):
        for row in rows:
            body = row[at[0]] or ""
            base = base_spans(body)
            spans = sorted([*base, *opaque_spans(body, base)])
            yield *row, [value_hash(value_of(k, body[s:e])) for s, k, e in spans]

    found = map_rows(documents, find, f"{fields}, `_hashes` array<binary>")
    found = staged(found, "masked")
    clean = found.where(F.size("_hashes") == 0).select(*[F.col(f"`{name}`") for name in names])
    dirty = found.where(F.size("_hashes") > 0).withColumn("_row", F.monotonically_increasing_id())
    dirty = staged(dirty, "masked")
    known = ownership(
        dirty.select(
            F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
            F.coalesce(F.col(repository).cast("string"), F.lit("")).alias("repository"),
            F.transform("_hashes", lambda h: F.struct(h.alias("hash"))).alias("found"),
        )
    ).where((F.col("n_owners") <= MAX_OWNERS) & (F.col("n_repositories") <= MAX_REPOSITORIES))
    live = (
        dirty.select("_row", F.explode("_hashes").alias("hash"))
        .join(known.select("hash"), "hash")
        .groupBy("_row")
        .agg(F.collect_set("hash").alias("_live"))
    )
    secret = dirty.drop("_hashes").join(live, "_row", "left").drop("_row")

    def mask(rows):
        for *row, hashes in rows:
            if hashes:
                row[at[0]] = replaced(row[at[0]], set(hashes))
            yield tuple(row)

    return clean.unionByName(map_rows(secret, mask, fields))


def replaced(body: str, live: set[bytes]) -> str:
    """The text with the values of live spans masked; overlapping values are masked as one."""
    base = base_spans(body)
    values = []
    for start, kind, end in [*base, *opaque_spans(body, base)]:
        value = value_of(kind, body[start:end])
        if value_hash(value) in live:
            values.append((end - len(value), end))
    out, at = [], 0
    for start, end in sorted(values):
        if start >= at:
            out.append(body[at:start] + MASK)
        at = max(at, end)
    return "".join(out) + body[at:]
