"""Secret scans: fixed rules, and character Markov models of random strings and identifiers.

The rules find assignments to secret names, access keys and long hexadecimal runs. The models add
what the rules have no form for: two character bigram models, one of random strings and one of
ordinary identifiers, give every token of 12 characters or more a log-likelihood ratio per pair of
characters. Both are trained here, on labelled samples from all documents. Samples of random strings
are the tokens within a rule's match. Samples of identifiers are the tokens in the form of words
(letters in a word's case, joined by ``+/_-``) or of numbers; a token that mixes letters and digits,
as unknown secrets do, labels nothing, so finding them does not depend on how many there are. Each
distinct token counts once, so copies of a document do not weigh more. Letters count in either case.

A token is a secret if its mean ratio exceeds a limit set from the samples: what all but one in a
thousand of the identifiers stay below, but no more than half of what uniformly random strings are
expected to reach and no less than ``MIN_MEAN``. Tokens that a rule's match covers in part are judged
like all others, so an added span may overlap a rule's; tokens within a match are left to the rule.

Offsets are in code points, ends exclusive. A null text counts as empty and has no spans; rows may
repeat or have null ids, each gets its own result; an empty table gives an empty result. Texts and
tokens are read whole, however long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.shared import attach, text_of, write_once

#: fixed values: the rules, in the order their kinds are listed. The repeat counts of access and hex
#: select the same matches as "+" with a later test of the length, as their runs have no inner start.
ASSIGN = (
    r"(?i)(password|passwd|secret|token|api_?key)"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ["assign", "access", "hex", "random"]
BASE_KINDS = 3
ASSIGNED_LENGTH = 12

#: tokens the models are trained on and judge; those in the form of words have nothing but joints
#: left when their words are taken out
TOKEN = r"[A-Za-z0-9+/_-]{12,}"
WORD = "[A-Z]?[a-z]{2,}"
JOINTS = "^[+/_-]*$"
CAPITALS_OR_NUMBERS = "^([A-Z+/_-]+|[0-9+/_-]+)$"
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789+/_-"
#: how much of the random model is the uniform one
UNIFORM_SHARE = 0.5
#: the most one pair of characters says (nats), the least mean ratio of a secret, and the share of
#: the identifiers that stay below the limit
MAX_PAIR = 3.0
MIN_MEAN = 0.25
BELOW_LIMIT = 0.999


def _matches(pattern: str) -> Column:
    return F.regexp_extract_all("text", F.lit(pattern), F.lit(0))


def _gaps(pattern: str, found: str) -> Column:
    """Lengths of the texts between matches; the second pass over a text without any is saved."""
    pieces = F.transform(F.split("text", pattern, -1), F.length)
    return F.when(F.size(found) > 0, pieces)


def scan(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(id, row_no, found): all matches of each document with the length of the gap before each."""
    patterns = [ASSIGN, ACCESS, HEX, TOKEN]
    rows = docs.select(
        F.col(id), F.monotonically_increasing_id().alias("row_no"), text_of(text).alias("text")
    )
    rows = rows.select("*", *(_matches(p).alias(f"found{k}") for k, p in enumerate(patterns)))
    rows = rows.select("*", *(_gaps(p, f"found{k}").alias(f"gaps{k}") for k, p in enumerate(patterns)))
    # zipped, so that the gaps are computed once per text and not once per match
    entries = [
        F.expr(
            f"if(size(found{k}) = 0, array(), transform(arrays_zip(gaps{k}, found{k}), (z, i) -> "
            f"named_struct('kind', {k}, 'n', i, 'gap', z.gaps{k}, 'match', z.found{k})))"
        )
        for k in range(len(patterns))
    ]
    return write_once(rows.select(id, "row_no", F.concat(*entries).alias("found")))


def placed(scanned: DataFrame) -> DataFrame:
    """(row_no, kind, start, end, match, inside): matches that hold, with their offsets.

    ``inside`` says whether a token lies within a rule's match. Sorting within one document does
    both, so very many matches in one text cost no more than their sort.
    """
    rows = scanned.select("row_no", F.inline("found")).filter("match is not null")
    rows = rows.withColumn("length", F.length("match"))
    rows = rows.withColumn(
        "end", F.expr("sum(gap + length) over (partition by row_no, kind order by n)")
    ).withColumn("start", F.expr("end - length"))
    value = F.length(F.regexp_extract("match", ASSIGN, 2))
    rows = rows.filter((F.col("kind") > 0) | (value >= ASSIGNED_LENGTH))
    reached = (
        f"max(if(kind < {BASE_KINDS}, end, null)) over (partition by row_no order by start, kind)"
    )
    return rows.select(
        *("row_no", "kind", "start", "end", "match"),
        F.expr(f"coalesce({reached} >= end, false)").alias("inside"),
    )


def bigrams(tokens: DataFrame) -> DataFrame:
    """One row per neighbouring pair of characters of each token, letters in lower case."""
    pairs = "transform(sequence(1, length(match) - 1), i -> substring(lower(match), i, 2))"
    return tokens.select("*", F.explode(F.expr(pairs)).alias("pair"))


def model(tokens: DataFrame) -> DataFrame:
    """(pair, ratio): log of how much likelier the pair is in random strings, for all pairs.

    ``tokens`` has one row per distinct token (match, is_random). The table has 1,600 rows.
    """
    letters = f"split('{ALPHABET}', '')"
    pairs = (
        tokens.sparkSession.range(1)
        .select(F.explode(F.expr(letters)).alias("first"))
        .select("first", F.explode(F.expr(letters)).alias("second"))
        .select("first", F.concat("first", "second").alias("pair"))
    )
    counts = bigrams(tokens).groupBy("pair").agg(
        F.count_if("is_random").alias("random"), F.count_if(~F.col("is_random")).alias("plain")
    )
    size = len(ALPHABET)
    share = "({0} + 1) / (sum({0}) over (partition by first) + {1})"
    random = f"{1 - UNIFORM_SHARE} * {share.format('random', size)} + {UNIFORM_SHARE} / {size}"
    return (
        pairs.join(counts, "pair", "left")
        .na.fill(0, ["random", "plain"])
        .selectExpr("pair", f"ln({random}) - ln({share.format('plain', size)}) as ratio")
    )


def ordinary(match: str = "match") -> Column:
    """Whether a token has the form of words or of numbers: a sample of ordinary identifiers."""
    words = F.regexp_replace(match, WORD, "").rlike(JOINTS)
    return words | F.col(match).rlike(CAPITALS_OR_NUMBERS)


def judge(tokens: DataFrame, min_mean: float = MIN_MEAN) -> DataFrame:
    """The rows of ``tokens`` (match, is_random, uses; one per distinct token) that are secrets."""
    labelled = tokens.withColumn("is_plain", ~F.col("is_random") & ordinary())
    samples = labelled.filter("is_random or is_plain").select("match", "is_random")
    ratios = write_once(
        model(samples).select("pair", F.least("ratio", F.lit(MAX_PAIR)).alias("ratio"))
    )
    scored = write_once(
        bigrams(labelled.filter("uses > 0").select("match", "uses", "is_plain"))
        .join(F.broadcast(ratios), "pair")
        .groupBy("match", "uses", "is_plain")
        .agg(F.round(F.avg("ratio"), 6).alias("mean"))
    )
    plain = F.when(F.col("is_plain"), F.col("mean"))
    below = scored.agg(F.percentile_approx(plain, BELOW_LIMIT, 10_000)).first()[0]
    expected = ratios.agg(F.avg("ratio")).first()[0]
    limit = max(min_mean, expected / 2 if below is None else min(below, expected / 2))
    return scored.filter(F.col("mean") > limit).select("match", "uses")


def find_secrets(
    docs: DataFrame, id: str = "doc_id", text: str = "text", min_mean: float = MIN_MEAN
) -> DataFrame:
    """One row per document: the id and ``found``, its spans (start, kind, end) in order.

    ``kind`` counts in the order of KINDS.
    """
    scanned = scan(docs, id, text)
    hits = write_once(placed(scanned))
    tokens = hits.filter(F.col("kind") == BASE_KINDS)
    distinct = write_once(
        tokens.groupBy("match").agg(
            F.bool_or("inside").alias("is_random"),
            F.count_if(~F.col("inside")).alias("uses"),
        )
    )
    total = distinct.agg(F.sum("uses")).first()[0] or 0
    added = attach(tokens.filter("not inside"), judge(distinct, min_mean), "match", "uses", total)
    span = ["row_no", "start", "kind", "end"]
    spans = hits.filter(F.col("kind") < BASE_KINDS).select(*span).unionByName(added.select(*span))
    per_row = spans.groupBy("row_no").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("found")
    )
    return scanned.select(id, "row_no").join(per_row, "row_no", "left").select(
        id, F.coalesce("found", F.expr("cast(array() as array<struct<start:long,kind:int,end:long>>)")).alias("found")
    )


def secret_report(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts per rule, the rules' spans as a hash, and all spans as text, per document."""
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    written = "transform({}, s -> concat_ws(':', " + names + "[s.kind], s.start, s.end))"
    base = f"filter(found, s -> s.kind < {BASE_KINDS})"
    counts = [
        F.expr(f"cast(size(filter(found, s -> s.kind = {k})) as long)").alias(f"n_{name}")
        for k, name in enumerate(KINDS[:BASE_KINDS])
    ]
    return find_secrets(docs, id, text).select(
        id,
        *counts,
        F.sha2(F.array_join(F.expr(written.format(base)), ","), 256).alias("base_sha256"),
        F.array_join(F.expr(written.format("found")), ",").alias("spans"),
    )
