"""Dictionary terms in a corpus, for dictionaries of any size, and glossary links.

Terms and texts meet by equi-joins, never all with all. Texts are read once: a word lists its parts
whose hash some term has, and those meet the terms. Terms with spaces go by their longest piece,
through an index of the distinct words of the corpus: a piece is looked up by its rarest n-gram there
and compared with the words that have it. A document gets its own terms only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as tx
from ..functions.common import explode_once, top_per_key
from ..functions.pyudf import possible_terms, term_linker
from ..session import cut_lineage

#: Characters of the n-grams of the word index; shorter terms are looked up whole.
GRAM = 3
#: Bits for the hashes of terms: for each term so many, within these bounds.
BITS, LEAST, MOST = 256, 1 << 20, 1 << 26
SPACES = "[ \\t\\n\\x0B\\f\\r]+"

# fixed values: character classes that bound a term
CLASSES = {"hiragana": "\\x{3040}-\\x{309F}", "katakana": "\\x{30A0}-\\x{30FF}\\x{FF65}-\\x{FF9F}",
           "kanji": "\\x{4E00}-\\x{9FFF}\\x{3400}-\\x{4DBF}", "ascii": "A-Za-z0-9"}


def rarest(keys: DataFrame, owner: str, key: str, index: DataFrame) -> DataFrame:
    """(owner, key): of the keys of each owner, the one with the fewest rows in ``index``.

    An owner with a key that the index lacks can match nothing and drops out.
    """
    used = index.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    found = keys.join(used, key, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    best = found.groupBy(owner).agg(F.min(F.struct("n", key)).alias("best"))
    return best.filter("best.n > 0").select(owner, F.col(f"best.{key}").alias(key))


def _pieces(text: Column) -> Column:
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def words_with(parts: DataFrame, words: DataFrame) -> DataFrame:
    """(part, word) where the part lies in the word; both tables hold distinct texts without spaces."""
    size = F.least(F.length("part"), F.lit(GRAM))
    sizes = sorted(r[0] for r in parts.select(size).distinct().collect())  # GRAM rows at most
    if not sizes:
        return parts.select("part", F.col("part").alias("word"))
    grams = explode_once(parts, ["part"], F.when(
        F.length("part") < GRAM, F.array("part")).otherwise(tx.grams("part", GRAM)), "gram")
    longer = explode_once(words, ["word"], F.array_distinct(F.concat(*[tx.grams("word", n) for n in sizes])), "gram")
    index = cut_lineage(longer.join(grams.select("gram").distinct(), "gram", "left_semi"))
    # a row per part: as a table its size is known, so a small one is sent to the index and not the reverse
    best = cut_lineage(rarest(grams, "part", "gram", index))
    return best.join(index, "gram").filter(F.contains("word", F.col("part"))).select("part", "word")


def _terms(terms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Terms of one piece, and the others with their pieces."""
    t = cut_lineage(terms.distinct().withColumn("pieces", _pieces(F.col("term"))).filter(F.size("pieces") > 0))
    single = t.filter((F.size("pieces") == 1) & (F.col("pieces")[0] == F.col("term"))).select("term")
    return single, t.join(single, "term", "left_anti")


def _words(texts: DataFrame, key: str) -> DataFrame:
    return explode_once(texts, [key], F.array_distinct(_pieces(F.col("body"))), "word")


def _several(several: DataFrame, texts: DataFrame, key: str, clean: bool) -> DataFrame:
    """(key, term) of terms of several pieces: by the longest piece and then in the whole body."""
    own = _words(texts, key)
    longest = F.aggregate("pieces", F.lit(""), lambda a, w: F.when(F.length(w) > F.length(a), w).otherwise(a))
    anchor = several.select("term", longest.alias("part"))
    index = words_with(anchor.select("part").distinct(), cut_lineage(own.select("word").distinct()))
    cand = own.join(index, "word").join(anchor, "part").select(key, "term").distinct()
    fits = (F.regexp_like("body", bounded_pattern(F.col("term"))) if clean
            else F.contains("body", F.col("term")))
    return texts.select(key, "body").join(cand, key).filter(fits).select(key, "term").distinct()


def _with_several(hits: DataFrame, several: DataFrame, texts: DataFrame, key: str, clean: bool) -> DataFrame:
    if several.isEmpty():  # the dictionary alone is read for this
        return hits
    return hits.unionByName(_several(several, texts, key, clean))


def _may_be(terms: DataFrame) -> dict:
    """Lengths of the terms, and bits for the hashes of terms and of their first characters.

    However many terms there are, the driver sees two bitmaps of at most ``MOST`` bits.
    """
    n, low, high = terms.agg(F.count(F.lit(1)), F.min(F.length("term")), F.max(F.length("term"))).first()
    low, high, size = low or 1, high or 0, LEAST
    while size < min(MOST, BITS * n):
        size *= 2

    def bits(text: Column) -> bytes:
        at = terms.select((F.crc32(text) % size + 1).alias("at"))
        out = bytearray(size // 8)
        for bucket, part in at.groupBy(F.bitmap_bucket_number("at")).agg(
                F.bitmap_construct_agg(F.bitmap_bit_position("at"))).collect():
            out[(bucket - 1) * len(part):bucket * len(part)] = part
        return bytes(out)

    return {"low": low, "high": high, "mask": size - 1, "bits": bits(F.col("term")),
            "starts": bits(F.substring("term", 1, low))}


def _hits(single: DataFrame, texts: DataFrame, key: str, clean: bool, k: int | None = None) -> DataFrame:
    return (possible_terms(texts, key, _may_be(single), clean, k).join(single, "term")
            .select(key, "term").distinct())


def term_occurrences(terms: DataFrame, texts: DataFrame, key: str) -> DataFrame:
    """(key, term) for every dictionary term found as a substring of ``body``.

    Spaces at the ends of a term do not count, and blank terms match nothing.
    """
    single, several = _terms(terms.select(F.trim("term").alias("term")))
    return _with_several(_hits(single, texts, key, False), several, texts, key, False)


def first_documents(occurrences: DataFrame, key: str, k: int = 8) -> DataFrame:
    return top_per_key(occurrences, ["term"], [F.col(key)], k)


def term_documents(terms: DataFrame, texts: DataFrame, key: str, k: int = 8) -> DataFrame:
    """``first_documents`` of ``term_occurrences``; a batch of texts gives ``k`` documents per term at most."""
    single, several = _terms(terms.select(F.trim("term").alias("term")))
    return first_documents(_with_several(_hits(single, texts, key, False, k), several, texts, key, False), key, k)


def bounded_pattern(term: Column) -> Column:
    """Pattern for a term not touched by characters of its own class at either end."""
    def edge(ch, before):
        out = F.lit("")
        for cls in CLASSES.values():
            look = f"(?<![{cls}])" if before else f"(?![{cls}])"
            out = F.when(ch.rlike(f"^[{cls}]$"), look).otherwise(out)
        return out

    quoted = F.concat(F.lit("\\Q"), F.replace(term, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
    return F.concat(edge(F.substring(term, 1, 1), True), quoted, edge(F.substring(term, -1, 1), False))


def dictionary_hits(terms: DataFrame, texts: DataFrame, key: str) -> DataFrame:
    """(key, term) where a term of two or more characters occurs with clean ends.

    What touches a term of one piece stands in the same word, so the texts are read once for such
    terms. Blank terms match nothing.
    """
    single, several = _terms(terms.filter(F.length("term") >= 2).select("term"))
    return _with_several(_hits(single, texts, key, True), several, texts, key, True)


def link_terms(corpus: DataFrame, terms: DataFrame, key: str) -> DataFrame:
    """Add ``linked``: the body with dictionary terms turned into links, the longest first.

    Each document gets the terms that occur in it; of several addresses a term keeps the smallest.
    """
    url = terms.filter(F.length("term") >= 2).groupBy("term").agg(F.min("url").alias("url"))
    own = (dictionary_hits(terms, corpus, key).join(url, "term").groupBy(key)
           .agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("term", "url")))).alias("dictionary")))
    found = corpus.join(own, key, "left")
    return found.withColumn("linked", F.when(F.col("dictionary").isNull(), F.col("body")).otherwise(
        term_linker(F.col("body"), F.col("dictionary")))).drop("dictionary")
