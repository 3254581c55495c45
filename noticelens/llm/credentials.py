"""Secret scans: spans by pattern, judged by who owns the same value across the corpus.

Patterns find candidate spans in the whole text. The hash of each candidate's value is
then counted over distinct owners and repositories: a value that many owners have was
copied from an example, one that a single owner has and that does not read like a
placeholder looks live; in several repositories of that owner it is reused, which makes
it no less live. Only DataFrame functions run on the rows.

Offsets count code points; the spans of a kind are the leftmost non-overlapping matches,
and a match whose value is too short is dropped but still used up its characters. The span
of a private key is the whole block, its value the body; a BEGIN line without one is no span.

Defined cases: null texts have no spans; without spans the digest is that of an empty
text and the list is empty; repeated rows are reported alike and count as one owner;
a null owner or repository is one of its own; other columns are not read; an empty table
gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from noticelens.session import lookup


@dataclass(frozen=True)
class Kind:
    """``hint`` is a text that every match contains, or a cheap pattern for it."""

    name: str
    pattern: str
    group: int
    least: int
    hint: str
    hint_is_pattern: bool = False


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_any_case(w) for w in ("password", "passwd", "secret", "token"))
_NAMES += "|" + _any_case("api") + "_?" + _any_case("key")

# A private key reaches from its BEGIN line to its END line; what is between holds no two
# dashes in a row. Without an END line it reaches as far as base64 lines go. Loops over
# groups are bounded, as Java recurses on them; those over characters are not.
_BASE64 = r"[A-Za-z0-9+/=\\]"
# Written out, as RE2 refuses counts inside of counts beyond 1,000.
_RUN = _BASE64 * 16 + _BASE64 + "*"
_BLANK = r"[\x20\t\r\n]*"
_TO_END = r"(?:[^-\x20\t\r\n][^-]*)?(?:-[^-]+){0,300}-?-----END"
_TO_LAST_LINE = (
    r"(?:[A-Za-z-]+:\x20[^\r\n]*[\r\n]+){0,8}"
    rf"(?:{_RUN}(?:[\x20\t\r]*\n[\x20\t]*|[\x20\t]+)){{0,300}}(?:{_BASE64}{_BASE64[:-1]}\r\n]*\n)?"
    rf"(?:{_RUN}|{_BASE64}+[\x20\t\r]*(?:\n|$))"
)
_PEM = rf"-----BEGIN [A-Z ]*PRIVATE KEY-----{_BLANK}({_TO_END}|{_TO_LAST_LINE})(?: [A-Z ]*PRIVATE KEY-----)?"

# The first three kinds are given, in this order; the others follow the
# published formats of the tokens that they name.
KINDS = (
    Kind("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, "[:=]", True),
    Kind("access", r"AKIA[A-Z0-9]{12,}", 0, 16, "AKIA"),
    Kind("hex", r"[0-9a-f]{32,}", 0, 32, "[0-9a-f]{32}", True),
    Kind("github", r"gh[oprsu]_[A-Za-z0-9]{36,}", 0, 40, "gh"),
    Kind("google", r"AIza[A-Za-z0-9_-]{35}", 0, 39, "AIza"),
    Kind("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 35, "eyJ"),
    # The value is the key's body, which the word of the END line closes if there is one.
    Kind("pem", _PEM, 1, 20, "-----BEGIN"),
    Kind("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15, "xox"),
    Kind("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}", 0, 24, "k_live_"),
)
BASE = ("assign", "access", "hex")

# Owners from which on a value counts as a copied example.
COPIED_BY = 3
# Parts of values that stand for "put yours here".
PLACEHOLDER = "(?i)example|sample|changeme|your|dummy|placeholder|xxxx"

MASK = "[REDACTED]"


def _key(id_col: str, text_col: str, owner: Column, repo: Column) -> Column:
    return F.xxhash64(F.col(id_col).cast("string"), F.col(text_col), owner, repo)


def _names(owner_col: str | None, repo_col: str | None) -> tuple[Column, Column]:
    owner = F.col(owner_col).cast("string") if owner_col else F.lit(None).cast("string")
    return owner, F.col(repo_col).cast("string") if repo_col else owner


def candidates(
    docs: DataFrame, id_col: str, text_col: str, owner_col: str | None, repo_col: str | None
) -> DataFrame:
    """(row, owner, repo, kind, rank, start, end, value) of every span."""
    owner, repo = _names(owner_col, repo_col)
    text = F.col("text")
    rows = docs.select(
        _key(id_col, text_col, owner, repo).alias("row"),
        owner.alias("owner"),
        repo.alias("repo"),
        F.col(text_col).alias("text"),
    )
    kinds = []
    for rank, kind in enumerate(KINDS):
        pattern = F.lit(kind.pattern)
        hinted = text.rlike(kind.hint) if kind.hint_is_pattern else F.contains(text, F.lit(kind.hint))
        parts = F.struct(
            F.lit(kind.name).alias("kind"),
            F.lit(rank).alias("rank"),
            F.lit(kind.least).alias("least"),
            F.arrays_zip(
                F.split(text, kind.pattern, -1).alias("before"),
                F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"),
                F.regexp_extract_all(text, pattern, F.lit(kind.group)).alias("value"),
            ).alias("parts"),
        )
        kinds.append(F.when(hinted, parts))
    cut = (
        rows.select("row", "owner", "repo", F.explode(F.array(*kinds)).alias("k"))
        .filter("k is not null and size(k.parts) > 1")
        .select("row", "owner", "repo", "k.kind", "k.rank", "k.least", F.posexplode("k.parts").alias("at", "part"))
        .filter("part.match is not null")
        .select(
            "row",
            "owner",
            "repo",
            "kind",
            "rank",
            "least",
            "at",
            F.length("part.before").alias("gap"),
            F.length("part.match").alias("size"),
            F.col("part.value").alias("value"),
        )
        .dropDuplicates(["row", "kind", "at"])
    )
    so_far = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("size")).over(so_far)
    return (
        cut.withColumn("end", end)
        .filter(F.length("value") >= F.col("least"))
        .select("row", "owner", "repo", "kind", "rank", (F.col("end") - F.col("size")).alias("start"), "end", "value")
    )


def spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str | None = "source",
    repo_col: str | None = None,
    copied_by: int = COPIED_BY,
) -> DataFrame:
    """(row, kind, rank, start, end, verdict, owners, repos) of every span.

    The verdict is ``example`` for placeholders and values of ``copied_by`` owners or more,
    ``shared`` for those of several owners, and for one owner's ``reused`` if as many of its
    repositories hold it, else ``live``.
    """
    found = candidates(docs, id_col, text_col, owner_col, repo_col)
    found = found.withColumn("hash", F.sha2("value", 256))
    owners = (
        found.groupBy("hash", "owner", "repo")
        .agg(F.lit(1).alias("one"))
        .groupBy("hash", "owner")
        .agg(F.count(F.lit(1)).alias("repos"))
        .groupBy("hash")
        .agg(F.count(F.lit(1)).alias("owners"), F.sum("repos").alias("repos"))
    )
    verdict = (
        F.when((F.col("owners") >= copied_by) | F.col("value").rlike(PLACEHOLDER), "example")
        .when(F.col("owners") > 1, "shared")
        .when(F.col("repos") >= copied_by, "reused")
        .otherwise("live")
    )
    return lookup(found, owners, ["hash"], spread=["row", "start"]).select(
        "row", "kind", "rank", "start", "end", verdict.alias("verdict"), "owners", "repos"
    )


def _listed(base_only: bool) -> Column:
    """kind:start:end of a row's spans by start, then kind, joined by commas."""
    entry = F.struct("start", "rank", "end", "kind")
    chosen = F.when(F.col("kind").isin(*BASE), entry) if base_only else entry
    return F.array_join(
        F.transform(
            F.array_sort(F.collect_list(chosen)),
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def report(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str | None = "source",
    repo_col: str | None = None,
    copied_by: int = COPIED_BY,
) -> DataFrame:
    """Counts, digest and list of the spans of every row.

    ``n_live`` counts the spans that look live, reused ones included, ``n_reused`` those;
    ``n_owners`` and ``n_repos`` are the most owners and repositories that hold one of the
    row's values, 0 without spans.
    """
    found = spans(docs, id_col, text_col, owner_col, repo_col, copied_by)
    per = found.groupBy("row").agg(
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in BASE],
        _listed(True).alias("base"),
        _listed(False).alias("spans"),
        F.count(F.when(F.col("verdict").isin("live", "reused"), 1)).alias("n_live"),
        F.count(F.when(F.col("verdict") == "reused", 1)).alias("n_reused"),
        F.count(F.when(F.col("verdict") == "example", 1)).alias("n_example"),
        F.max("owners").alias("n_owners"),
        F.max("repos").alias("n_repos"),
    )
    owner, repo = _names(owner_col, repo_col)
    rows = docs.select(F.col(id_col).alias("id"), _key(id_col, text_col, owner, repo).alias("row"))
    out = lookup(rows, per, ["row"], "left", spread=["id"])
    empty = F.lit("")
    return out.select(
        F.col("id").alias(id_col),
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(F.coalesce("base", empty), 256).alias("base_sha256"),
        F.coalesce("spans", empty).alias("spans"),
        *[
            F.coalesce(c, F.lit(0)).cast("long").alias(c)
            for c in ("n_live", "n_reused", "n_example", "n_owners", "n_repos")
        ],
    )


def redact(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str | None = "source",
    repo_col: str | None = None,
    copied_by: int = COPIED_BY,
) -> DataFrame:
    """All rows and columns, with every span masked that is not a copied example."""
    found = spans(docs, id_col, text_col, owner_col, repo_col, copied_by).filter("verdict != 'example'")
    per = found.groupBy("row").agg(
        F.array_sort(
            F.collect_list(F.struct(F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end")))
        ).alias("__spans")
    ).withColumnRenamed("row", "__row")
    owner, repo = _names(owner_col, repo_col)
    marked = docs.withColumn("__row", _key(id_col, text_col, owner, repo))
    marked = lookup(marked, per, ["__row"], "left", spread=[id_col])
    text = F.col(text_col)

    def mask(so_far: Column, span: Column) -> Column:
        # A span that overlaps the one before only lengthens the masked part.
        gap = text.substr(so_far["at"] + 1, F.greatest(span["start"] - so_far["at"], F.lit(0)))
        apart = (span["start"] > so_far["at"]) | (so_far["out"] == "")
        return F.struct(
            F.when(apart, F.concat(so_far["out"], gap, F.lit(MASK))).otherwise(so_far["out"]).alias("out"),
            F.greatest(so_far["at"], span["end"]).alias("at"),
        )

    masked = F.aggregate(
        "__spans",
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        mask,
        lambda done: F.concat(done["out"], text.substr(done["at"] + 1, F.length(text))),
    )
    new = F.when(F.col("__spans").isNotNull(), masked).otherwise(text)
    return marked.select(*[new.alias(c) if c == text_col else F.col(c) for c in docs.columns])
