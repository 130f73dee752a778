"""Matching: queries to articles, related items, terms, domains and search ranking.

Related items go through shared features (tags, codes) with short lists per feature. Searches
compare every query with every item in pairs of bounded blocks (``functions.blocks``), so common
words, long texts and matches inside words are all seen; scores are whole numbers.
"""

from __future__ import annotations

import sys
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions import blocks as bl
from ..functions import cases as ca
from ..functions import constants as C
from ..functions import text as tx
from ..functions.common import any_of, count_if, explode_once, numbered, r6, ratio, top_per_key
from ..session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the searches

# --------------------------------------------------------------- J04 / G03 coverage

FIELDS = ("svc", "code", "comp", "tag", "title", "rel", "tq")


def field_tokens(articles: DataFrame) -> DataFrame:
    """Token arrays per knowledge field of an article."""
    generic = F.array(*[F.lit(w) for w in C.GENERIC_SERVICE_WORDS])
    flat = lambda c: tx.text_tokens(F.array_join(c, "\n"))  # noqa: E731  # a line feed parts tokens
    code = F.lower(F.col("code"))
    return articles.select(
        "slug", F.array_except(tx.text_tokens("service"), generic).alias("svc"),
        F.when(code != "", F.array(code)).otherwise(F.array().cast("array<string>")).alias("code"),
        flat("components").alias("comp"), flat("tags").alias("tag"), tx.text_tokens("title").alias("title"),
        F.array_except(flat("related_services"), generic).alias("rel"), flat("top_queries").alias("tq"))


#: Tenths of a point that the first, second, ... matched word of a field adds; all together are 145.
COVERAGE_POINTS = {"svc": (50,), "code": (40,), "comp": (10, 10), "tag": (10,), "title": (3, 3, 3, 1),
                   "rel": (5,), "tq": (10,)}


#: Points without the fields that name an article: its service and its code.
NAMING = ("svc", "code")
WEAK = sum(sum(gains) for f, gains in COVERAGE_POINTS.items() if f not in NAMING)
#: Words of bits that are looked at together.
TOGETHER = 32_768


def _coverage(state: dict, items: tuple):
    """Best item per query, equal ones by rank; a field's n-th bit is set where n words matched.

    A query whose best item so far has more points than ``WEAK`` is not beaten by an item whose service
    and code it does not name, so of the rows of bits it looks at the words that hold such an item.
    """
    q, rank, items = bl.Words.of(state), items[1], bl.BitTable.of(items[0])
    least = state.setdefault("least", np.zeros(len(q.size), np.int64))
    number, rows = items.rows(q.keys)
    none, width = len(rows) - 1, items.width
    rows = np.ascontiguousarray(rows.reshape(-1, len(FIELDS), width).transpose(0, 2, 1))
    at = number[q.number]
    row, at = q.row[at < none], at[at < none]
    start = np.searchsorted(row, np.arange(len(q.size) + 1))
    named = np.bitwise_or.reduce(rows[..., [FIELDS.index(f) for f in NAMING]], axis=2)
    key, word = np.nonzero(named)
    first = np.searchsorted(key, np.arange(none + 2))
    strong = least[row] > WEAK
    size = first[at[strong] + 1] - first[at[strong]]
    pairs = np.repeat(row[strong] * width, size) + word[ca.spans(first[at[strong]], size)]
    open_ = np.flatnonzero((least <= WEAK) & (np.diff(start) > 0))
    pairs = np.unique(np.concatenate([pairs, (open_[:, None] * width + np.arange(width)).ravel()]))
    steps = [(i, n, gain) for i, f in enumerate(FIELDS) for n, gain in enumerate(COVERAGE_POINTS[f])]
    found: list[tuple] = []
    for low in range(0, len(pairs), TOGETHER):
        who, where = pairs[low:low + TOGETHER] // width, pairs[low:low + TOGETHER] % width
        order = np.argsort(-(start[who + 1] - start[who]), kind="stable")  # those with most words first
        who, where = who[order], where[order]
        left = start[who + 1] - start[who]
        levels = np.zeros((len(steps), len(who)), np.uint64)
        for turn in range(int(left[0])):
            m = int(np.searchsorted(-left, -turn))  # pairs with more words than that
            bits = rows[at[start[who[:m]] + turn], where[:m]].T
            for j in range(len(steps) - 1, -1, -1):
                i, n, _ = steps[j]
                levels[j, :m] |= bits[i] & levels[j - 1, :m] if n else bits[i]
        total: list[np.ndarray] = [np.zeros(len(who), np.uint64)]
        for j, (_, _, gain) in enumerate(steps):
            bl.add(total, levels[j], gain)
        best, value = np.bitwise_or.reduce(total, axis=0), np.zeros(len(who), np.int64)
        for i in range(len(total) - 1, -1, -1):
            here = best & total[i]
            best = np.where(here != 0, here, best)
            value += (here != 0).astype(np.int64) << i
        keep = (value > 0) & (value >= least[who])
        np.maximum.at(least, who[keep], value[keep])
        keep &= value >= least[who]
        found.append((who[keep], where[keep], best[keep], value[keep]))
    who, where, best, value = (np.concatenate(x) for x in zip(*found)) if found else (pairs,) * 4
    if len(who):
        keep = value >= least[who]
        who, where, best, value = who[keep], where[keep], best[keep], value[keep]
        pair, bit = np.nonzero(np.unpackbits(best.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        column = where[pair] * 64 + bit
        order = np.lexsort((rank[column], who[pair]))
        order = order[ca.runs(who[pair][order])]
        yield who[pair][order], column[order], value[pair][order]


def best_articles(queries: DataFrame, fields: DataFrame, **sizes) -> DataFrame:
    """Best-covering article per query: (query_id, slug, score); lowest slug on ties.

    queries: query_id, q_tok. Every query meets every article, in blocks of ``sizes``; words meet by
    64-bit hashes. Articles of one code stand side by side in a block, as far as a run of blocks goes.
    """
    hashes = lambda c: F.transform(F.array_distinct(c), lambda x: F.xxhash64(x)).alias(c)
    q = queries.select("query_id", hashes("q_tok"))
    f = fields.select("slug", *[hashes(c) for c in FIELDS])
    f = f.withColumn("_near", F.coalesce(F.get("code", F.lit(0)), F.lit(0).cast("long")))

    def pack_items(a: pd.DataFrame) -> tuple:
        sizes = [a[f].map(len).to_numpy() for f in FIELDS]
        key = np.concatenate([np.asarray(x, np.int64) for f in FIELDS for x in a[f]])
        rank = pd.factorize(a["slug"], sort=True)[0]
        return (vars(bl.BitTable(key, np.repeat(np.arange(len(FIELDS)), [s.sum() for s in sizes]),
                                 np.concatenate([np.repeat(np.arange(len(a)), s) for s in sizes]), len(a), len(FIELDS))),
                np.where(rank < 0, len(a), rank))

    kinds = dict(q.dtypes) | dict(f.dtypes)
    size = lambda *cols: sum((F.size(c) for c in cols), F.lit(0)) * 8
    found = bl.in_blocks(q, f, size("q_tok"), size(*FIELDS), lambda q: vars(bl.Words(list(q["q_tok"]))), pack_items, _coverage,
                         f"query_id {kinds['query_id']}, slug {kinds['slug']}, points long", 1, near=["_near", "slug"],
                         **({"q_rows": 32_000, "q_chars": 16_000_000} | sizes))
    top = found.groupBy("query_id").agg(
        F.min(F.struct((-F.col("points")).alias("neg"), F.col("slug").alias("slug"))).alias("b"))
    return (queries.select("query_id").join(top, "query_id", "left")
            .select("query_id", F.coalesce("b.slug", F.lit("")).alias("best_match_slug"),
                    F.coalesce(-F.col("b.neg") / 145, F.lit(0.0)).alias("match_score")))


def coverage_class(score: Column, covered: float = 0.60, partial: float = 0.25) -> Column:
    return (F.when(score >= covered, "covered").when(score >= partial, "partial")
            .otherwise("uncovered"))


def coverage_summary(classified: DataFrame) -> DataFrame:
    s = classified.agg(F.count(F.lit(1)).alias("total_queries"),
                       *[count_if(F.col("coverage") == c).alias(c)
                         for c in ("covered", "partial", "uncovered")])
    return s.withColumn("coverage_rate", ratio("covered", "total_queries"))


def gap_candidates(classified: DataFrame, top: int = 20) -> DataFrame:
    """Best opportunities among queries not covered; uncovered first on ties."""
    late = F.when(F.col("coverage") == "uncovered", 0).otherwise(1)
    return (classified.filter((F.col("coverage") != "covered") & (F.col("opportunity_score") > 0))
            .orderBy(F.desc(r6("opportunity_score")), late, "query_id").limit(top))


def infer_service(q_tok: Column, table: dict = C.SERVICE_MAP) -> Column:
    """Service of the lowest mapped token; empty when none is mapped."""
    m = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    known = F.array_sort(F.array_intersect(q_tok, F.array(*[F.lit(k) for k in table])))
    return F.coalesce(F.try_element_at(m, F.get(known, F.lit(0))), F.lit(""))


def infer_components(q_tok: Column, table: dict = C.COMPONENT_MAP, k: int = 3) -> Column:
    m = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    known = F.array_sort(F.array_intersect(q_tok, F.array(*[F.lit(t) for t in table])))
    return F.slice(F.transform(known, lambda t: F.try_element_at(m, t)), 1, k)


def suggest_title(query: Column) -> Column:
    """Article title for a query: capitalized words and a rule-based ending."""
    ws = F.filter(F.split(query, "\\s+"), lambda w: w != "")

    def capitalize(w):
        head = F.upper(F.substring(w, 1, 1))  # one letter may become two
        return F.concat(F.substring(head, 1, 1), F.lower(F.substr(head, F.lit(2))),
                        F.lower(F.substr(w, F.lit(2))))

    capped = F.array_join(F.transform(ws, lambda w: F.when(
        (F.length(w) <= 3) & w.rlike("^\\p{L}+$"), F.upper(w)).otherwise(capitalize(w))), " ")
    ending = F.when(query.rlike("\\b([1-5]\\d{2})\\b"), C.TITLE_CODE_ENDING)
    for ws_, end in C.TITLE_RULES:
        ending = ending.when(F.lower(query).rlike(any_of(ws_)), end)
    return F.concat(capped, ending.otherwise(C.TITLE_OTHER_ENDING))


# ------------------------------------------------------------------ related items


def related_items(items: DataFrame, k: int = 20, guide: str = "learning guide",
                  min_score: int = 3) -> DataFrame:
    """Top related items: +5 same service (+100 if a guide), +1 same type, +3 per component.

    Items with the same service, type and components form a profile and share
    one result list. Every profile is listed under the feature combinations it
    carries, each list holding its first k + 1 items. The true match of two
    profiles is one of these combinations, and whoever is ahead of an item in
    that list scores at least as much, so the lists hold all results without
    pairing the items of a service.
    """
    comps = F.array_sort(F.array_distinct("components"))
    profile = F.to_json(F.struct("service", "error_type", comps.alias("comps")))
    own = items.select("item", "service", "error_type", comps.alias("components"),
                       profile.alias("profile"))
    keys = F.flatten(F.flatten(F.transform(tx.subsets("components"), lambda u: F.transform(
        F.array(F.lit(True), F.lit(False)), lambda s: F.transform(
            F.array(F.lit(True), F.lit(False)), lambda t: F.struct(
                F.when(s, F.col("service")).alias("svc"), F.when(t, F.col("error_type")).alias("typ"),
                u.alias("comps")))))))
    base = (F.when(F.col("key.svc").isNotNull(), 5).otherwise(0)
            + F.when(F.col("key.typ").isNotNull(), 1).otherwise(0) + 3 * F.size("key.comps"))
    # an empty service or type matches nothing
    sane = (F.coalesce("key.svc", F.lit("x")) != "") & (F.coalesce("key.typ", F.lit("x")) != "")
    guided = F.col("key.svc").isNotNull() & (F.col("error_type") == guide)

    def cards(df, keep):
        c = explode_once(df, [*keep, "error_type"], F.array_distinct(keys), "key")
        # the combination as one text: cheap to shuffle and sort by
        return (c.withColumn("base", base).filter((F.col("base") >= min_score) & sane)
                .select(*keep, "base", F.when(guided, 1).otherwise(0).alias("g"),
                        F.to_json("key").alias("card")))

    firsts = top_per_key(own, ["profile"], [F.col("item")], k + 1)
    lists = top_per_key(cards(firsts, ["item"]), ["card"], [F.desc("g"), F.col("item")], k + 1)
    lists = lists.select("card", F.col("item").alias("related"),
                         (F.col("base") + 100 * F.col("g")).alias("score"))
    profiles = own.drop("item").dropDuplicates(["profile"])
    hits = (cards(profiles, ["profile"]).select("profile", "card").join(lists, "card")
            .groupBy("profile", "related").agg(F.max("score").alias("score")))
    best = top_per_key(hits, ["profile"], [F.desc("score"), F.col("related")], k + 1)
    per_profile = best.groupBy("profile").agg(F.array_sort(F.collect_list(
        F.struct("rank", "related", "score"))).alias("list"))  # k + 1 entries at most
    mine = F.slice(F.filter("list", lambda x: x["related"] != F.col("item")), 1, k)
    return (own.select("item", "profile").join(per_profile, "profile")
            .select("item", F.explode(mine).alias("r")).select("item", "r.related", "r.score"))


def related_by_tag(items: DataFrame, k: int = 3) -> DataFrame:
    """First k other items sharing a tag."""
    cards = items.select("item", F.explode(F.array_distinct("tags")).alias("tag"))
    firsts = top_per_key(cards, ["tag"], [F.col("item")], k + 1).select(
        "tag", F.col("item").alias("related"))
    hits = cards.join(firsts, "tag").filter(F.col("item") != F.col("related"))
    return top_per_key(hits.select("item", "related").distinct(), ["item"], [F.col("related")], k)


def same_code_other_tags(items: DataFrame, k: int = 3, block: int = 128, salts: int = 16) -> DataFrame:
    """First k items of the same code that share no tag.

    The distinct tag sets of a code scan its items in order, block by block, and stop as soon as they
    have k + 1 without a shared tag: most after the first block, so a round compares few sets with
    eight times the blocks of the round before. Items beyond the first k + 1 of a tag set are never
    needed. Sets of a code are spread over ``salts`` tasks.
    """
    sig = items.filter(F.col("code") != "").select(
        "item", "code", F.array_sort(F.array_distinct("tags")).alias("sig"))
    firsts = top_per_key(sig, ["code", "sig"], [F.col("item")], k + 1).drop("rank")
    place = numbered(firsts, "code", "item", "place")
    every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    blocks = cut_lineage(
        place.groupBy("code", F.floor(F.col("place") / block).alias("block"))
        .agg(F.array_sort(F.collect_list(F.struct(F.col("item"), F.col("sig").alias("other")))).alias("entries")))
    ends = blocks.groupBy("code").agg(F.max("block").alias("last"))
    opened = cut_lineage(firsts.select("code", "sig").distinct().withColumn("n", F.lit(0).cast("long")))
    found, low, width = [], 0, 1
    while not opened.isEmpty():
        near = blocks.filter((F.col("block") >= low) & (F.col("block") < low + width)).withColumn("salt", every)
        free = F.transform(F.filter("entries", lambda e: ~F.arrays_overlap("sig", e["other"])), lambda e: e["item"])
        hits = (opened.withColumn("salt", F.pmod(F.xxhash64("sig"), F.lit(salts)).cast("int"))
                .join(near, ["code", "salt"]).select("code", "sig", "n", F.slice(free, 1, k + 1).alias("free")))
        hits = top_per_key(hits.select("code", "sig", "n", F.explode("free").alias("related")),
                           ["code", "sig"], [F.col("related")], k + 1)
        found.append(cut_lineage(hits.filter(F.col("n") + F.col("rank") <= k + 1).select("code", "sig", "related")))
        low, width = low + width, width * 8
        more = found[-1].groupBy("code", "sig").agg(F.count(F.lit(1)).alias("more"))
        opened = cut_lineage(
            opened.join(ends, "code").filter(F.col("last") >= low).join(more, ["code", "sig"], "left")
            .select("code", "sig", (F.col("n") + F.coalesce("more", F.lit(0))).alias("n"))
            .filter(F.col("n") <= k))
    if not found:
        return sig.select("item", "code", F.col("item").alias("related"), F.lit(0).alias("rank")).limit(0)
    lists = reduce(DataFrame.unionByName, found)
    hits = sig.join(lists, ["code", "sig"]).filter(F.col("item") != F.col("related"))
    return top_per_key(hits.select("item", "code", "related"), ["item"], [F.col("related")], k)


# ----------------------------------------------------------- containment and grids


def match_incidents(articles: DataFrame, incidents: DataFrame, key: str) -> DataFrame:
    """Articles whose service contains, or is contained in, an incident's service,
    or with a component among its keywords. Empty services match nothing.

    Containment is an equi-join on the substrings of the distinct service names.
    """
    a = articles.select(F.lower("service").alias("service")).filter(F.col("service") != "").distinct()
    i = incidents.select(F.lower("service").alias("inc")).filter(F.col("inc") != "").distinct()
    inside = (explode_once(a, ["service"], tx.substrings("service"), "inc")
              .join(i, "inc", "left_semi").select("service"))
    around = (explode_once(i, [], tx.substrings("inc"), "service")
              .join(a, "service", "left_semi").select("service"))
    names = inside.union(around).distinct()
    words = incidents.select(F.explode("keywords").alias("w")).select(F.lower("w").alias("w")).distinct()
    by_name = articles.select(key, F.lower("service").alias("service")).join(
        names, "service", "left_semi").select(key)
    by_word = articles.select(key, F.explode("components").alias("w")).select(
        key, F.lower("w").alias("w")).join(words, "w", "left_semi").select(key)
    return articles.join(by_name.union(by_word).distinct(), key, "left_semi")


def coverage_grid(tools: DataFrame, codes, covered: DataFrame, trending: DataFrame,
                  limit: int | None = None, seed: int = 42) -> DataFrame:
    """Tool x code pairs not covered yet, trending ones first, the rest in hash order.

    Each tool lists the fixed codes itself, so the grid is a projection.
    """
    grid = tools.select("tool").distinct().withColumn(
        "code", F.explode(F.array(*[F.lit(c) for c in codes])))
    open_pairs = grid.join(covered.select("tool", "code"), ["tool", "code"], "left_anti")
    hot = trending.select("tool", "code").distinct().withColumn("trending", F.lit(True))
    out = open_pairs.join(hot, ["tool", "code"], "left").withColumn(
        "trending", F.coalesce("trending", F.lit(False)))
    if limit is None:
        return out
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("tool").cast("string"),
                          F.col("code").cast("string")))
    return out.orderBy(F.desc("trending"), h).limit(limit)


def work_grid(documents: DataFrame, rounds: int, finished: DataFrame) -> DataFrame:
    """(path, round) jobs not finished yet; sort by (round, path) for round-robin order."""
    jobs = documents.select("path", F.explode(F.sequence(F.lit(1), F.lit(rounds))).alias("round"))
    return (jobs.withColumn("key", F.concat("path", F.lit("::"), F.col("round").cast("string")))
            .join(finished.select("key"), "key", "left_anti"))


def context_lookup(titles: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """First result whose query has a word over two letters inside the title, else the first.

    Words are reduced to their first result. A query word has no white space, so it lies inside one
    title word: the distinct words of all titles meet query words on their substrings, no longer
    than the longest query word.
    """
    words = (results.select("ord", F.explode(F.split(F.lower("query"), "\\s+")).alias("word"))
             .filter(F.length("word") > 2).groupBy("word").agg(F.min("ord").alias("ord")))
    longest = words.agg(F.max(F.length("word")).alias("longest"))  # one row
    first = results.agg(F.min("ord").alias("first"))  # one row
    parts = explode_once(titles, [key], F.array_distinct(F.split(F.lower("title"), "\\s+")), "part")
    cut = explode_once(parts.select("part").distinct().join(F.broadcast(longest)),
                       ["part"], tx.substrings("part", 3, "longest"), "word")
    best = cut.join(words, "word").groupBy("part").agg(F.min("ord").alias("ord"))
    hit = parts.join(best, "part").groupBy(key).agg(F.min("ord").alias("ord"))
    return (titles.select(key).join(hit, key, "left").join(F.broadcast(first))
            .select(key, F.coalesce("ord", "first").alias("ord")))


# ---------------------------------------------------------------- sources and evidence


def tier_counts(urls: DataFrame, doc: str, kind: str, kinds, redirect: str) -> DataFrame:
    """URLs per document and tier, with the share of redirect URLs."""
    n = F.count(F.lit(1))
    return urls.groupBy(doc).agg(
        *[count_if(F.col(kind) == t).alias(t) for t in kinds], n.alias("urls"),
        (count_if(F.col(kind) == redirect) / n).alias("redirect_share"))


def evidence_summary(sources: DataFrame, doc: str, valid: Column) -> DataFrame:
    """Counts that decide whether a document's sources need review."""
    v = valid
    return sources.groupBy(doc).agg(
        count_if(v).alias("sources"),
        count_if(v & F.col("kind").isin("official", "vendor_community")).alias("good"),
        count_if(v & F.col("tool_match")).alias("tool_matches"),
        count_if(v & (F.col("kind") == "unresolved")).alias("unresolved"))


def review_triggers(max_unresolved: float = 0.5) -> Column:
    """Reasons for review; documents without sources are incomplete, not queued."""
    share = ratio("unresolved", "sources")
    return F.array_compact(F.array(
        F.when(F.col("sources") == 0, "incomplete"),
        F.when((F.col("sources") > 0) & (F.col("good") == 0), "no official sources"),
        F.when((F.col("sources") > 0) & (F.col("tool_matches") == 0), "no tool match"),
        F.when((F.col("sources") > 0) & (share >= max_unresolved), "many unresolved")))


def source_quality(sources: DataFrame, doc: str) -> DataFrame:
    """Quality delta per document: duplicates per claim and invalid URLs are counted out.

    sources: doc, claim, url, source_type, kind, ord.
    """
    ok = F.col("url").rlike("^https?://[^/?#\\s]+")
    claim = F.when(F.trim("claim") == "", "__general__").otherwise(F.trim("claim"))
    bad = sources.filter(~ok).groupBy(doc).agg(F.count(F.lit(1)).alias("bad"))
    first = (sources.filter(ok).groupBy(doc, claim.alias("claim"), "url").agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by(F.struct("source_type", "kind"), "ord").alias("s")))
    g = first.groupBy(doc).agg(
        F.count(F.lit(1)).alias("valid"), F.sum(F.col("n") - 1).cast("long").alias("dup"),
        count_if(F.col("s.source_type").isin(*C.LOW_QUALITY_TYPES)).alias("low"),
        count_if(F.col("s.source_type").isin(*C.HIGH_QUALITY_TYPES)).alias("high"),
        count_if(F.col("s.kind") == "official").alias("official"))
    j = g.join(bad, doc, "full_outer").fillna(0)
    share = ratio("official", "valid")
    delta = (F.when(F.col("low") == F.col("valid"), -20).when(F.col("high") > 0, 10).otherwise(0)
             + F.when(F.col("official") == 0, -10).when(share >= 0.5, 5).otherwise(0))
    return j.select(doc, "valid", (F.col("dup") + F.col("bad")).alias("invalid"),
                    F.when(F.col("valid") > 0, delta).otherwise(0).alias("quality_delta"))


def submitted_urls(log: DataFrame, since: str) -> DataFrame:
    """Distinct URLs submitted with status ok since a date."""
    return (log.filter((F.col("date") >= F.lit(since).cast("date")) & (F.col("status") == "ok"))
            .select(F.explode("urls").alias("url")).agg(F.countDistinct("url").alias("urls")))


# ------------------------------------------------------------------- article search


def query_code(query: Column) -> Column:
    q = F.trim(F.regexp_replace(F.lower(query), "　", " "))
    return F.regexp_extract(q, "\\b[1-5]\\d{2}\\b", 0)


def query_terms(query: Column) -> Column:
    """Words of a query without its error code."""
    q, code = F.trim(F.regexp_replace(F.lower(query), "　", " ")), query_code(query)
    q = F.when(code != "", F.regexp_replace(q, F.concat(F.lit("\\b"), code, F.lit("\\b")),
                                            F.lit(" "))).otherwise(q)
    return F.filter(F.split(q, "\\s+"), lambda w: w != "")


def article_class(permalink: Column, code: Column) -> Column:
    """Error documents 0, other posts 1, glossary 2."""
    return F.when(permalink.contains("/glossary/"), 2).when(code != "", 0).otherwise(1)


#: Places of a found article, best first: 100 * rank + 10 * class, 1 more without a code and all terms.
PLACES = np.array([0, 10, 20, 100, 110, 120, 200, 210, 220, 300, 301, 410, 411, 520, 521])


#: The last place of an article with the code of the query.
CODED = 120


def _articles_found(q: tuple, a: tuple, k: int):
    """The first ``k`` items per query in the order of their places, equal ones by rank.

    A query that has ``k`` items with its code looks only at the words of bits with such items.
    """
    state, q_code = q
    words, held, codes, classes, by_id = bl.Words.of(state), bl.Held.of(a[0]), *a[1:]
    if "parts" not in state:
        state["parts"], state["best"] = ca.Parts(list(words.keys)), np.full((len(q_code), k), PLACES[-1] + 1)
    best = state["best"]  # places so far, the last one first
    at, own = pd.factorize(codes)
    code_at = pd.Index(own).get_indexer(q_code)  # -1 where no item has the code
    done = best[:, 0] <= CODED
    number, rows = held.rows(state["parts"])
    used = np.arange(len(rows)) < len(rows) - 1
    whole = np.bincount(words.row[used[number[words.number]]], minlength=len(q_code)) == words.size
    flags = np.zeros((4, held.width * 64), np.uint8)
    flags[classes, np.arange(held.n)] = 1
    flags[3, :held.n] = 1
    of_class = bl.as_bits(flags)
    code_rows = np.zeros((len(own) + 1, held.width * 64), np.uint8)
    code_rows[at, np.arange(held.n)] = 1
    code_rows = bl.as_bits(code_rows)
    # where the items of a code are
    first = np.append((code_rows != 0).argmax(axis=1)[:-1], 0)
    span = np.append(held.width - (code_rows != 0)[:, ::-1].argmax(axis=1)[:-1], 0) - first
    near = np.flatnonzero(done & (code_at >= 0))
    some_words = int(span[code_at[near]].max(initial=1))
    end = np.append(0, np.cumsum(words.size))

    def in_order(bits: np.ndarray) -> np.ndarray:
        """Rows of bits with the columns by id; items of one code are by id as they stand."""
        out = np.zeros((len(bits), held.width * 64), np.uint8)
        out[:, :held.n] = np.unpackbits(bits.view(np.uint8), axis=1, bitorder="little")[:, by_id]
        return bl.as_bits(out)

    for chosen, some_width in ((near, some_words), (np.flatnonzero(~done), held.width)):
        if chosen.size and chosen is not near:
            rows, of_class, code_rows = in_order(rows), in_order(of_class), in_order(code_rows)
        for low in range(0, len(chosen), 512):
            who = chosen[low:low + 512]
            begin = np.minimum(first[code_at[who]], held.width - some_width) if chosen is near else who * 0
            columns = begin[:, None] + np.arange(some_width)
            some = np.zeros(columns.shape, np.uint64)
            tool = of_class[3][columns]
            size = words.size[who]
            row = np.repeat(np.arange(len(who)), size)
            token = number[words.number[ca.spans(end[who], size)]]
            row, token = row[used[token]], token[used[token]]
            turn = np.arange(len(row)) - np.searchsorted(row, np.arange(len(who)))[row]
            order = np.argsort(turn, kind="stable")
            for part in np.split(order, np.cumsum(np.bincount(turn))[:-1]) if len(turn) else ():
                mine, at = row[part], token[part]
                bits = rows[at[:, None], columns[mine]]
                some[mine] |= bits
                tool[mine] &= bits
            tool[~(whole & (words.size > 0))[who]] = 0
            coded = np.where((q_code[who] != "")[:, None], ~np.uint64(0), np.uint64(0))
            same = code_rows[code_at[who][:, None], columns] & coded
            rest = some & ~same & ~(tool & coded)
            rest[done[who]], some_tool = 0, tool & coded & ~same
            some_tool[done[who]] = 0
            total: list[np.ndarray] = [np.zeros_like(some)]
            for rank, here in ((0, same & tool), (1, same & ~tool), (2, some_tool), (3, rest)):
                for cls in range(3):
                    mine = here & of_class[cls][columns]
                    place = 100 * (rank + cls * (rank == 3)) + 10 * cls
                    late = mine & ~coded & ~tool if rank == 3 else np.zeros_like(mine)
                    bl.add(total, mine & ~late, len(PLACES) - int(np.searchsorted(PLACES, place)))
                    if rank == 3:
                        bl.add(total, late, len(PLACES) - int(np.searchsorted(PLACES, place + 1)))
            for row, column, found in bl.highest(total, k):
                place = PLACES[len(PLACES) - found]
                keep = place <= best[who[row], 0]
                row, column, place = row[keep], column[keep], place[keep]
                best[who[row], 0] = place
                best[who[row]] = -np.sort(-best[who[row]], axis=1)
                column = begin[row] * 64 + column
                yield who[row], column if chosen is near else by_id[column], -place


def search_articles(queries: DataFrame, articles: DataFrame, k: int = 10, **sizes) -> DataFrame:
    """Top articles per query among those with its code or one of its terms in the title.

    queries: query_id, query. articles: slug, title, code, permalink. Rank 0 has the code and all
    terms, 1 the code, 2 all terms beside another code, 3 and more the rest by class.
    """
    text = F.coalesce("query", F.lit(""))
    q = queries.select("query_id", query_code(text).alias("q_code"),
                       F.array_distinct(query_terms(text)).alias("terms"))
    a = articles.select("slug", F.regexp_replace(F.lower(F.coalesce("title", F.lit(""))), "　", " ").alias("t"),
                        F.coalesce("code", F.lit("")).alias("code"),
                        article_class(F.coalesce("permalink", F.lit("")),
                                      F.coalesce("code", F.lit(""))).alias("cls"))

    def pack_items(a: pd.DataFrame) -> tuple:
        rank = pd.factorize(a["slug"], sort=True)[0]
        return (vars(bl.Held(a["t"])), a["code"].to_numpy(object), a["cls"].to_numpy(np.int64),
                np.argsort(np.where(rank < 0, len(a), rank), kind="stable"))

    kinds = dict(q.dtypes) | dict(a.dtypes)
    found = bl.in_blocks(
        q, a, F.size("terms") * 8, F.length("t"),
        lambda q: (vars(bl.Words([list(t) for t in q["terms"]])), q["q_code"].to_numpy(object)), pack_items,
        lambda q, a: _articles_found(q, a, k),
        f"query_id {kinds['query_id']}, slug {kinds['slug']}, place long", k, near=["code", "slug"],
        **({"q_rows": 32_000, "q_chars": 16_000_000} | sizes))
    return top_per_key(found.select("query_id", "slug", F.expr("int(-place div 100)").alias("search_rank"), "place"),
                       ["query_id"], [F.desc("place"), F.col("slug")], k, "position").drop("place")


# ---------------------------------------------------------------------- case search


def _norm(c) -> Column:
    return tx.mask_error_text(F.coalesce(c, F.lit("")))


def _lists() -> list[Column]:
    """Messages of a case, as they are and normalized, and the words of its service."""
    messages = F.coalesce("messages", F.array().cast("array<string>"))
    return [messages.alias("messages"), F.transform(messages, _norm).alias("n_list"),
            tx.case_tokens(F.coalesce("service", F.lit(""))).alias("s_tok")]


def prepare_cases(cases: DataFrame) -> DataFrame:
    """Normalize the searched fields once per case.

    cases: case_id, messages, code, name, service, situation, aliases, cause.
    """
    joined = lambda c: F.array_join(F.coalesce(c, F.array().cast("array<string>")), " ")
    return cases.select(
        "case_id", *_lists(),
        *[_norm(F.col(f)).alias(f"n_{f}") for f in ("code", "name", "service", "situation", "cause")],
        _norm(joined(F.col("aliases"))).alias("n_aliases"))


def prepare_queries(queries: DataFrame) -> DataFrame:
    return queries.select("query_id", _norm(F.col("query")).alias("qn"),
                          tx.case_tokens(F.coalesce("query", F.lit(""))).alias("qt"))


def rank_cases(queries: DataFrame, cases: DataFrame, k: int = 12, **sizes) -> DataFrame:
    """Best ``k`` cases per query among all that give a signal: (query_id, case_id, case_rank, position); ties by id.

    Every query meets every case, in blocks of ``sizes`` (``functions.cases``). Cases are normalized on
    their way into the blocks, without their messages, and stored nowhere else.
    """
    q = prepare_queries(queries)
    own = [f"n_{f}" for f in ca.NAMES[1:]]
    narrow = prepare_cases(cases).select("case_id", "n_list", "s_tok", *own)
    kinds = dict(q.dtypes) | dict(narrow.dtypes)
    size = F.length(F.concat_ws(" ", F.array_join("n_list", " "), *own))
    sizes = {"q_rows": 20_000, "q_chars": 8_000_000, "i_rows": 1600, "i_chars": 6_400_000} | sizes
    found = bl.in_blocks(q, narrow, F.length("qn"), size, ca.pack_queries, ca.pack_cases, lambda q, c: ca.search(q, c, k),
                         f"query_id {kinds['query_id']}, case_id {kinds['case_id']}, points long", k, **sizes)
    top = top_per_key(found, ["query_id"], [F.desc("points"), F.col("case_id")], k, "position")
    return top.select("query_id", "case_id", (-F.col("points") / 10).alias("case_rank"), "position")


#: Queries of a found case that get their messages at a time, and cases of a task for that.
ASKED, DEALT = 512, 5000


def search_cases(queries: DataFrame, cases: DataFrame, k: int = 12, **sizes) -> DataFrame:
    """``rank_cases`` with the message of each found case.

    The queries that found a case meet its messages together, at most about ``ASKED`` of them in a row,
    so a long case that many queries find is not copied for each. Messages are exchanged as they are;
    those of found cases are normalized after that.
    """
    ranked = rank_cases(queries, cases, k, **sizes)
    n = F.count(F.lit(1)).over(Window.partitionBy("case_id"))
    asked = ranked.withColumn("_n", F.ceil(n / ASKED)).join(prepare_queries(queries).select("query_id", "qn"), "query_id")
    groups = asked.groupBy("case_id", F.pmod(F.xxhash64("query_id"), F.col("_n")).alias("_part")).agg(
        F.collect_list(F.struct("query_id", "qn", "case_rank", "position")).alias("asked"))
    # as many tasks as there are cores or more: much is done per byte
    parts = max(cases.sparkSession.sparkContext.defaultParallelism, -(-cases.count() // DEALT))
    shown = (cases.select("case_id", "messages", "service").repartition(parts, "case_id").join(groups, "case_id")
             .select("case_id", "asked", *_lists()))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                found = ca.messages(row["messages"], row["n_list"], row["s_tok"], [a["qn"] for a in row["asked"]])
                yield pa.RecordBatch.from_pylist(
                    [{**{c: a[c] for c in ("query_id", "case_rank", "position")}, "case_id": row["case_id"], "message": m}
                     for a, m in zip(row["asked"], found)], pa.schema([
                         ("query_id", kinds["query_id"]), ("case_id", kinds["case_id"]), ("message", pa.string()),
                         ("case_rank", pa.float64()), ("position", pa.int32())]))

    types = dict(ranked.dtypes)
    kinds = {c: to_arrow_type(ranked.schema[c].dataType) for c in ("query_id", "case_id")}
    return shown.mapInArrow(run, f"query_id {types['query_id']}, case_id {types['case_id']}, message string, "
                                 "case_rank double, position int")
