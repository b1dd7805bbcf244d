"""Secret scan with corpus-wide ownership frequency, all in DataFrame functions.

One pass finds the spans of every text: the fixed patterns, and any long token that
mixes letters and digits. The hashes of all candidates are counted by distinct owners
and repositories over the whole corpus. A value that many owners, or many repositories
of one owner, have is an example that was copied; any other looks live, and such tokens
are added to the spans even where no fixed pattern names them.

Positions come from the pieces between the matches: the text is split at the pattern,
and lengths of pieces and matches are added up, in code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.lookup import heavy_keys, salted_lookup, with_position
from tallyloom.runtime import materialize

# Kinds in the order of the output, and their patterns. A run of the
# characters of `access` or `hex` that is too short cannot hold a longer one, so its
# least length is part of the pattern; an assignment that is too short still uses up
# its text and is dropped afterwards.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
TOKEN = r"[A-Za-z0-9+/_-]{20,}"
KINDS = ["assign", "access", "hex", "owned"]
MIN_ASSIGNED = 8

#: A candidate that more owners have is a copied example.
MAX_OWNERS = 1
#: And so is one that more repositories of its owner have.
MAX_REPOSITORIES = 2
PIECE = 128
#: A value with a larger share of all spans is divided into parts of that share.
HEAVY = 0.01

_FOUND = "array<struct<start:bigint,kind:int,stop:bigint,value:string>>"


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once, however often the body names it:
    what a lambda takes from outside is worked out again for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, op, zero: int) -> Column:
    """Running results of ``op`` over an array of whole numbers, the current one included.

    Arrays are copied when they grow, so one fold would take time with the square of the
    length. Pieces of ``PIECE`` are folded by themselves, then their ends.
    """
    start = F.lit(zero).cast("bigint")
    none = F.array().cast("array<bigint>")

    def fold(piece: Column) -> Column:
        return F.aggregate(piece, F.struct(start.alias("at"), none.alias("out")), lambda s, x: F.struct(
            op(s["at"], x).alias("at"), F.concat(s["out"], F.array(op(s["at"], x))).alias("out")))

    def join(folded: Column) -> Column:
        ends = F.aggregate(folded, F.struct(start.alias("at"), none.alias("out")), lambda s, f: F.struct(
            op(s["at"], f["at"]).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")))["out"]
        return F.flatten(F.zip_with(folded, ends, lambda f, end: F.transform(f["out"], lambda x: op(end, x))))

    def pieces(all_values: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(all_values) - 1) / PIECE).cast("int"))
        return F.transform(numbers, lambda i: fold(F.slice(all_values, i * PIECE + 1, PIECE)))

    return _let(values, lambda v: F.when(F.size(v) > 0, _let(pieces(v), join)).otherwise(none))


def _spans(text: Column, matches: Column, pattern: str, kind: int, value) -> Column:
    """(start, kind, stop, value) of the matches of a pattern, in order."""
    def place(found: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        steps = F.zip_with(gaps, found, lambda g, m: (F.char_length(g) + F.char_length(m)).cast("bigint"))
        stops = running(steps, lambda a, x: a + x, 0)
        return F.zip_with(found, stops, lambda m, stop: F.struct(
            (stop - F.char_length(m)).alias("start"), F.lit(kind).alias("kind"), stop.alias("stop"),
            value(m).alias("value")))

    # most texts have no match and are not split
    return F.when(F.size(matches) > 0, _let(matches, place)).otherwise(F.array().cast(_FOUND))


def _free(base: Column, tokens: Column) -> Column:
    """The tokens that overlap no base span. Of all spans in order, a token is free if no
    base span up to it ends behind its start and none after it starts before its end."""
    far = (1 << 62)

    def judge(every: Column) -> Column:
        ends = running(F.transform(every, lambda s: F.when(s["kind"] < 3, s["stop"]).otherwise(0)), F.greatest, 0)
        starts = F.reverse(running(
            F.transform(F.reverse(every), lambda s: F.when(s["kind"] < 3, s["start"]).otherwise(far)), F.least, far))
        flagged = F.zip_with(F.zip_with(every, ends, lambda s, end: F.struct(s.alias("s"), (end <= s["start"]).alias("clear"))),
                             starts, lambda x, start: F.struct(
                                 x["s"].alias("s"), (x["clear"] & (start >= x["s"]["stop"])).alias("free")))
        return F.transform(F.filter(flagged, lambda x: x["free"] & (x["s"]["kind"] == 3)), lambda x: x["s"])

    some = (F.size(base) > 0) & (F.size(tokens) > 0)
    return F.when(some, _let(F.array_sort(F.concat(base, tokens)), judge)).otherwise(tokens)


def scan(documents: DataFrame, owner: str = "source", repository: str = "lang") -> DataFrame:
    """(_row, doc_id, owner, repository, base, tokens) of every document: spans of the
    fixed patterns, and of other tokens that mix letters and digits."""
    text = F.coalesce(F.col("text"), F.lit(""))
    source = documents.select(
        "doc_id", F.col(owner).cast("string").alias("owner"), F.col(repository).cast("string").alias("repository"),
        text.alias("text"))
    patterns = [ASSIGN, ACCESS, HEX, TOKEN]
    matched = source.select("*", *[
        F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(f"m{i}") for i, p in enumerate(patterns)])
    assigned = F.filter(
        _spans(F.col("text"), F.col("m0"), ASSIGN, 0, lambda m: F.regexp_extract(m, ASSIGN, 2)),
        lambda s: F.char_length(s["value"]) >= MIN_ASSIGNED)
    base = F.concat(assigned, _spans(F.col("text"), F.col("m1"), ACCESS, 1, lambda m: m),
                    _spans(F.col("text"), F.col("m2"), HEX, 2, lambda m: m))
    mixed = F.exists("m3", lambda m: m.rlike("[0-9]") & m.rlike("[A-Za-z]"))
    tokens = F.when(mixed, _spans(F.col("text"), F.col("m3"), TOKEN, 3, lambda m: m)).otherwise(
        F.array().cast(_FOUND))
    tokens = F.filter(tokens, lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]"))
    found = matched.select("doc_id", "owner", "repository", F.array_sort(base).alias("base"), tokens.alias("tokens"))
    return found.withColumn("tokens", _free(F.col("base"), F.col("tokens"))).withColumn("_row", F.monotonically_increasing_id())


def ownership(candidates: DataFrame) -> DataFrame:
    """(hash, owners, repositories, n) of candidates (hash, owner, repository). Each level
    is combined in the tasks first, so a hash with a third of all rows is no hot key. A
    null owner or repository counts as one of its own."""
    n = F.count(F.lit(1)).alias("n")
    repositories = candidates.groupBy("hash", "owner", "repository").agg(n)
    owners = repositories.groupBy("hash", "owner").agg(
        F.count(F.lit(1)).alias("repositories"), F.sum("n").alias("n"))
    return owners.groupBy("hash").agg(
        F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"), F.sum("n").alias("n"))


def _listed(spans: Column) -> Column:
    """kind:start:stop of every span, comma-joined."""
    name = F.lit(KINDS)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(name, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def _count(spans: str, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def find_secrets(documents: DataFrame, owner: str = "source", repository: str = "lang",
                 max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """One row per row of ``documents``: doc_id, n_assign, n_access, n_hex, base_sha256,
    spans, n_live (spans whose value looks live: at most ``max_owners`` owners and
    ``max_repositories`` repositories have it) and n_example.

    A null text is empty and has no spans. Repeated rows are scanned each for itself and
    count as one owner and repository. Spans are in code points, the end exclusive.
    Other columns are not looked at.
    """
    scanned = materialize(scan(documents, owner, repository), "secret-scan")
    every = scanned.where((F.size("base") > 0) | (F.size("tokens") > 0)).select(
        "_row", "owner", "repository", F.explode(F.concat("base", "tokens")).alias("span"))
    every = materialize(every.withColumn("hash", F.sha2(F.col("span.value"), 256)), "secret-spans")
    owned = ownership(every.select("hash", "owner", "repository")).select(
        F.col("hash").alias("_hash"),
        ((F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories)).alias("live"))
    # a value with a large share of all spans is spread over several tasks
    heavy = heavy_keys(every, "hash", HEAVY, HEAVY)
    judged = salted_lookup(with_position(every), owned, "hash", "_hash", heavy).select("_row", "span", "live")
    judged = judged.where(F.col("live") | (F.col("span.kind") < 3))
    plain = F.struct(F.col("span.start").alias("start"), F.col("span.kind").alias("kind"),
                     F.col("span.stop").alias("stop"))
    per_row = judged.groupBy("_row").agg(  # the spans of one document
        F.array_sort(F.collect_list(plain)).alias("all"),
        F.count_if("live").alias("n_live"), F.count_if(~F.col("live")).alias("n_example"))
    joined = scanned.select("_row", "doc_id", "base").join(per_row, "_row", "left")
    counts = [_count("base", kind).alias(f"n_{KINDS[kind]}") for kind in range(3)]
    return joined.select(
        "doc_id", *counts, F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        F.coalesce(_listed(F.col("all")), F.lit("")).alias("spans"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_live", "n_example")])
