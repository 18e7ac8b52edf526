"""Secret spans in texts, and weak parts of credentials that count only together.

Strong spans (assignments to secret names, access keys, long hexadecimal runs) always count. Weak
parts (user names, mixed tokens, addresses) are interval-joined with complementary parts
of the same text: a part counts where its complement lies within a scope around it. The join sweeps all
parts of a text in order with running maxima, so it is linear in the parts and builds no pairs.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ctrflow.llm.frames import let, prefix_sums, shielded
from ctrflow.scratch import materialize


def any_case(word: str) -> str:
    """A pattern of the ASCII letters of ``word`` in either case."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(any_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
_IDENTS = "|".join(any_case(w) for w in ("user_?name", "user", "login", "client_?id", "account_?id", "access_?key_?id"))
_SET = r"""["']?\x20*[:=]\x20*["']?"""

#: Kinds in the order in which they are listed; strong ones first. The value is the least length of
#: the match, or of its second group for ``assign``.
STRONG = ("assign", "access", "hex")
WEAK = ("ident", "secret", "endpoint")
KINDS = STRONG + WEAK
PATTERNS = {
    "assign": rf"({_NAMES}){_SET}([A-Za-z0-9+/_.=-]+)",
    # a run of these letters is one match, so the least length can stand in the pattern
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
    "ident": rf"({_IDENTS}){_SET}[A-Za-z0-9@._-]+",
    "secret": r"[A-Za-z0-9+/_-]{32,}",
    "endpoint": r"""https?://[^\x00-\x20"'<>]+""",
}
LEAST_VALUE = 6
#: A weak secret has a digit, a small and a capital letter.
MIXED = (r"[0-9]", r"[a-z]", r"[A-Z]")
#: Plain strings, in lower case, one of which every match holds: far cheaper to look for than the pattern.
HINTS = {
    "assign": ("password", "passwd", "secret", "token", "api"),
    "access": ("akia",),
    "ident": ("user", "login", "client", "account", "access"),
    "endpoint": ("://",),
}
#: Code points between a weak part and its complement, at most.
SCOPE = 200

_NO_SPANS = "array<struct<start:bigint,kind:int,stop:bigint>>"


def _kept(kind: str, value: Column) -> Column:
    if kind == "assign":
        return F.length(F.regexp_extract(value, PATTERNS[kind], 2)) >= LEAST_VALUE
    if kind == "secret":
        return F.rlike(value, F.lit(MIXED[0])) & F.rlike(value, F.lit(MIXED[1])) & F.rlike(value, F.lit(MIXED[2]))
    return F.lit(True)


def spans(text: Column, kind: str) -> Column:
    """Leftmost, non-overlapping matches as ``(start, kind, stop)``, in code points."""
    pattern = F.lit(PATTERNS[kind])

    def placed(found: Column) -> Column:
        def located(gaps: Column) -> Column:
            lengths = F.transform(
                found, lambda m, i: F.length(m).cast("bigint") + F.length(F.get(gaps, i)).cast("bigint")
            )
            return let(
                prefix_sums(lengths),
                lambda before: F.transform(
                    found,
                    lambda m, i: F.struct(
                        (F.get(before, i) + F.length(F.get(gaps, i))).alias("start"),
                        F.lit(KINDS.index(kind)).alias("kind"),
                        F.get(before, i + 1).alias("stop"),
                        _kept(kind, m).alias("kept"),
                    ),
                ),
            )

        some = F.transform(
            F.filter(let(F.split(text, PATTERNS[kind], -1), located), lambda s: s["kept"]),
            lambda s: F.struct(s["start"], s["kind"], s["stop"]),
        )
        return F.when(F.size(found) > 0, some).otherwise(F.array().cast(_NO_SPANS))

    return let(F.regexp_extract_all(text, pattern, F.lit(0)), placed)


def find(docs: DataFrame, text: str = "text", keep: list[str] | None = None, scope: int = SCOPE) -> DataFrame:
    """Add ``strong`` and ``spans`` to every row: arrays of ``(start, kind, stop)``.

    ``strong`` holds the spans of strong kinds, ``spans`` also the weak ones that count, both by start and
    then by kind; ``kind`` is the place in ``KINDS``. A weak identifier counts near a secret (an assignment,
    a hexadecimal run, a mixed token), a mixed token near an identifier, an address near both.
    What is found depends on the text alone, so copies share it. Null and empty texts have
    no spans. ``keep`` names the columns that stay (default: all); a column of an added name is replaced.
    """
    added = ["strong", "spans"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    docs, names, own = shielded(docs, keep, text)
    source = F.coalesce("__t", F.lit(""))

    def hinted(kind: str) -> Column:
        if kind not in HINTS:
            return spans(source, kind)
        there = let(
            F.lower(source), lambda t: reduce(or_, [F.contains(t, F.lit(h)) for h in HINTS[kind]])
        )
        return F.when(there, spans(source, kind)).otherwise(F.array().cast(_NO_SPANS))

    found = {k: hinted(k) for k in KINDS}
    scanned = materialize(
        docs.select(
            *names,
            F.sort_array(F.concat(*[found[k] for k in STRONG])).alias("strong"),
            F.concat(*[found[k] for k in WEAK]).alias("__weak"),
            F.sha2(source, 256).alias("__text"),
        ),
        "secrets",
    )
    alone = scanned.where(F.size("__weak") == 0).withColumn("spans", F.col("strong"))
    some = scanned.where(F.size("__weak") > 0)
    parts = some.select("__text", F.explode(F.concat("strong", "__weak")).alias("s")).distinct()
    linked = (
        _counting(parts.select("__text", "s.*"), scope)
        .groupBy(F.col("__text").alias("__linked"))
        .agg(F.collect_list(F.struct("start", "kind", "stop")).alias("__more"))
    )
    joined = some.join(linked, F.col("__text") == F.col("__linked"), "left").withColumn(
        "spans",
        F.sort_array(F.concat("strong", F.coalesce("__more", F.array().cast(_NO_SPANS)))),
    )
    return alone.select(*own, *added).unionByName(joined.select(*own, *added))


def _counting(parts: DataFrame, scope: int) -> DataFrame:
    """The weak parts that have their complements within the scope.

    A complement meets a part if it starts no later than ``scope`` after the part's end, and ends no earlier
    than ``scope`` before its start. So of all complements that start early enough the largest end decides.
    """
    weak = F.col("kind").isin([KINDS.index(k) for k in WEAK])
    give = parts.select("*", F.col("start").alias("at"), F.lit(0).alias("asks"))
    take = parts.where(weak).select("*", (F.col("stop") + scope).alias("at"), F.lit(1).alias("asks"))
    sofar = (
        Window.partitionBy("__text").orderBy("at", "asks", "start", "kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )

    def reach(*kinds: str) -> Column:
        of = F.col("kind").isin([KINDS.index(k) for k in kinds]) & (F.col("asks") == 0)
        return F.coalesce(F.max(F.when(of, F.col("stop"))).over(sofar), F.lit(-scope - 1))

    seen = give.unionByName(take).select(
        "*", reach("access", "ident").alias("ids"), reach("assign", "hex", "secret").alias("secrets")
    )
    low = F.col("start") - scope
    has_id, has_secret = F.col("ids") >= low, F.col("secrets") >= low
    kind = {k: F.col("kind") == KINDS.index(k) for k in WEAK}
    return seen.where("asks = 1").where(
        (kind["ident"] & has_secret) | (kind["secret"] & has_id) | (kind["endpoint"] & has_id & has_secret)
    )


def listed(found: Column) -> Column:
    """Spans as text: ``kind:start:stop``, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])), ","
    )


def redact(text: Column, found: Column, mark: str = "[secret]") -> Column:
    """``text`` with each run of touching or overlapping spans replaced by ``mark``."""
    begin = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))

    def step(done, s):
        gap = F.substring(text, (done["at"] + 1).cast("int"), F.greatest(s["start"] - done["at"], F.lit(0)).cast("int"))
        fresh = (s["start"] > done["at"]) | (done["at"] == 0)
        return F.struct(
            F.concat(done["out"], gap, F.when(fresh, F.lit(mark)).otherwise("")).alias("out"),
            F.greatest(done["at"], s["stop"]).alias("at"),
        )

    whole = F.aggregate(
        found, begin, step,
        lambda done: F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.length(text))),
    )
    return F.when(F.size(found) > 0, whole).otherwise(text)
