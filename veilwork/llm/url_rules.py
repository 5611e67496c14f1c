"""URL verdicts: a given rule list, and association rules mined from labelled URLs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The rules of the production query, (host, path start, verdict).
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
LABEL = "="  # starts the items that are labels; no URL token has it


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ? # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_suffixes(host: Column) -> Column:
    """The host and all its parent domains, longest first."""
    labels = F.split(host, r"\.", -1)
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )


def listed_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as struct(length, rule, verdict), or null.

    A rule fits its host and all subdomains where the path starts with the rule's path. The
    list is a literal map from host to its rules, so each URL looks up its own suffixes only.
    """
    if not rules:
        return F.lit(None).cast("struct<length:int,rule:string,verdict:string>")
    by_host: dict[str, list[tuple[str, str]]] = {}
    for rule_host, start, verdict in rules:
        by_host.setdefault(rule_host, []).append((start, verdict))
    pairs: list[Column] = []
    for rule_host, entries in by_host.items():
        pairs += [
            F.lit(rule_host),
            F.array(*[
                F.struct(
                    F.lit(len(rule_host + p)).alias("length"), F.lit(rule_host + p).alias("rule"),
                    F.lit(v).alias("verdict"), F.lit(p).alias("start"),
                ) for p, v in entries
            ]),
        ]
    index = F.create_map(*pairs)
    known = F.flatten(
        F.transform(host_suffixes(host), lambda s: F.coalesce(F.try_element_at(index, s), F.slice(pairs[1], 1, 0)))
    )
    fits = F.filter(known, lambda r: F.startswith(path, r["start"]))
    return F.array_max(F.transform(fits, lambda r: F.struct(r["length"], r["rule"], r["verdict"])))


def tokens(url: Column) -> Column:
    """Sorted distinct tokens: host labels and their parts, first folder, suffix, query keys.

    Numbers are left out, so URLs that differ in a page number have the same tokens.
    """
    host, path = host_of(url), path_of(url)
    labels = F.split(host, r"\.", -1)
    tag = lambda kind: lambda t: F.concat(F.lit(kind), t)
    parts = F.filter(F.split(host, r"[.-]", -1), lambda p: ~F.array_contains(labels, p))
    first = F.translate(F.regexp_extract(path, r"\A/([^/.]+)", 1), UPPER, LOWER)
    suffix = F.translate(F.regexp_extract(path, r"\.([A-Za-z0-9]{1,8})\z", 1), UPPER, LOWER)
    query = F.coalesce(F.regexp_extract(url, r"\A[^?#]*\?([^#]*)", 1), F.lit(""))
    keys = F.transform(F.split(query, "&", -1), lambda p: F.regexp_extract(p, r"\A([^=]*)", 1))
    whole = F.concat(
        F.transform(labels, tag("host:")),
        F.transform(parts, tag("part:")),
        F.array(F.concat(F.lit("folder:"), first), F.concat(F.lit("suffix:"), suffix)),
        F.transform(keys, tag("key:")),
    )
    return F.array_sort(F.array_distinct(F.filter(whole, lambda t: t.rlike(r":(?!\d+\z)[^=]"))))


def token_groups(sets: DataFrame) -> DataFrame:
    """(token, group, members) of the tokens in distinct `tokens` sets.

    Tokens that occur in the same sets are a group, named by its first token; two
    fingerprints of the sets and their number stand for "the same sets".
    """
    held = sets.select(
        F.explode("tokens").alias("token"), F.xxhash64("tokens").alias("x"), F.xxhash64("tokens", F.lit(1)).alias("y")
    )
    marks = held.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    # At most the tokens of one URL: all members are in each of the sets.
    members = marks.groupBy("n", "x", "y").agg(F.sort_array(F.collect_list("token")).alias("members"))
    return members.select(F.explode("members").alias("token"), F.col("members")[0].alias("group"), "members")


def mine_rules(
    labelled: DataFrame, min_support: float = 0.005, min_confidence: float = 0.8
) -> DataFrame:
    """FP-growth over (tokens array<string>, label string): which token sets imply a label.

    Returns (rule_id, antecedent, label, confidence, support). A rule goes if a part of its
    tokens implies the same label as surely. Spark mines the labelled rows in parallel, each
    group of tokens in its own compressed tree. Without labelled rows there are no rules.

    Tokens that always occur together are mined as one: n of them would be in 2^n frequent
    sets, of which only those with one of them can survive the pruning. Each member then
    stands in for its group, which gives the same rules.
    """
    known = labelled.where(F.col("label").isNotNull() & (F.size("tokens") > 0)).select("tokens", "label")
    sets = known.select("tokens").distinct()
    groups = token_groups(sets)
    named = (
        sets.withColumn("token", F.explode("tokens"))
        .join(groups.where(F.col("token") == F.col("group")).select("token"), "token")
        .groupBy("tokens").agg(F.collect_list("token").alias("groups"))
    )
    baskets = known.join(named, "tokens").select(F.concat("groups", F.array(F.concat(F.lit(LABEL), "label"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    mined = model.associationRules.where(F.startswith(F.col("consequent")[0], F.lit(LABEL))).select(
        F.array_sort("antecedent").alias("antecedent"),
        F.substring(F.col("consequent")[0], 2, 1 << 20).alias("label"),
        "confidence",
        "support",
    )
    rules = _members_for_groups(_least_rules(mined), groups)
    return rules.withColumn("rule_id", F.md5(F.concat_ws("\n", F.col("label"), F.col("antecedent")))).select(
        "rule_id", "antecedent", "label", "confidence", "support"
    )


def _members_for_groups(rules: DataFrame, groups: DataFrame) -> DataFrame:
    """Every rule once for each choice of one member per group."""
    facts = ["label", "confidence", "support"]
    rules = rules.select("rule_id", "antecedent", *facts)
    choices = rules.select("rule_id", *facts, F.explode("antecedent").alias("group")).join(
        groups.where(F.col("token") == F.col("group")).select("group", "members"), "group"
    )
    listed = choices.groupBy("rule_id", *facts).agg(F.collect_list("members").alias("choices"))
    # One array of antecedents, widened group by group.
    every = F.aggregate(
        "choices",
        F.array(F.array().cast("array<string>")),
        lambda done, members: F.flatten(
            F.transform(done, lambda begun: F.transform(members, lambda m: F.array_append(begun, m)))
        ),
    )
    chosen = listed.select(*facts, F.explode(every).alias("_chosen"))
    return chosen.select(F.array_sort("_chosen").alias("antecedent"), *facts)


def _least_rules(rules: DataFrame) -> DataFrame:
    """`rules` without those of which a part implies the same label as surely, with a rule_id."""
    rules = rules.withColumn("rule_id", F.md5(F.concat_ws("\n", F.col("label"), F.col("antecedent"))))
    smaller = rules.select(
        F.col("antecedent").alias("_part"), F.col("label").alias("_label"), F.col("confidence").alias("_sure")
    )
    smaller = smaller.withColumn("_token", F.col("_part")[0])
    implied = (
        rules.withColumn("_token", F.explode("antecedent"))
        .join(smaller, "_token")
        .where(
            (F.col("label") == F.col("_label"))
            & (F.col("_sure") >= F.col("confidence"))
            & (F.size("_part") < F.size("antecedent"))
            & (F.size(F.array_except("_part", "antecedent")) == 0)
        )
        .select("rule_id")
        .distinct()
    )
    return rules.join(implied, "rule_id", "left_anti")


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The best rule of every distinct token set in `urls` (tokens): (tokens, mined).

    An inverted index lists a rule under one of its tokens, the one in the fewest rules; a
    set looks up its tokens and keeps the rules it holds whole. Best is the surest, then the
    best supported, the longest, the smallest id.
    """
    in_rules = rules.withColumn("_token", F.explode("antecedent"))
    rare = in_rules.groupBy("_token").agg(F.count(F.lit(1)).alias("_uses"))
    index = in_rules.join(rare, "_token").groupBy("rule_id").agg(
        F.min(F.struct("_uses", "_token"))["_token"].alias("_token"),
        *[F.first(c).alias(c) for c in ("antecedent", "label", "confidence", "support")],
    )
    sets = urls.select("tokens").distinct()
    found = (
        sets.withColumn("_token", F.explode("tokens"))
        .join(index, "_token")
        .where(F.size(F.array_except("antecedent", "tokens")) == 0)
    )
    best = F.struct("confidence", "support", F.size("antecedent").alias("length"), "rule_id", "antecedent", "label")
    return found.groupBy("tokens").agg(F.max(best).alias("mined"))


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    labelled: DataFrame | None = None,
    min_support: float = 0.005,
    min_confidence: float = 0.8,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """Verdict of every URL: its rule in the list, else the mined rules, else allow.

    Returns page_id, host, path, rule, verdict, mined_tokens, confidence; one row per input
    row. `labelled` has (url, label); without it, the URLs that the list judges are the
    labels. A null url, or one without ://, has empty host and path, no tokens and the
    verdict allow. Repeated rows are judged alike; no rows give no rows.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("_url")).select(
        "page_id", host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"), tokens(F.col("_url")).alias("tokens")
    )
    rows = rows.withColumn("_listed", listed_rule(F.col("host"), F.col("path"), rules))
    if labelled is None:
        known = rows.select("tokens", F.col("_listed.verdict").alias("label"))
    else:
        known = labelled.select(tokens(F.col("url")).alias("tokens"), "label")
    mined = match_rules(rows.where(F.col("_listed").isNull()), mine_rules(known, min_support, min_confidence))
    mined = mined.withColumnRenamed("tokens", "_tokens")
    judged = rows.join(mined, F.col("tokens") == F.col("_tokens"), "left")
    unlisted = F.col("_listed").isNull()
    return judged.select(
        "page_id",
        "host",
        "path",
        F.col("_listed.rule").alias("rule"),
        F.coalesce(F.col("_listed.verdict"), F.col("mined.label"), F.lit("allow")).alias("verdict"),
        F.when(unlisted, F.array_join("mined.antecedent", " ")).alias("mined_tokens"),
        F.when(unlisted, F.col("mined.confidence")).alias("confidence"),
    )
