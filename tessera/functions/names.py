"""Organisation names: normalising, query variants, tokens and similarity, as Column functions.

Word characters are letters, numbers and underscore in the Unicode sense; Java's own \\w and \\b
differ from that between versions, so the classes are written out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words and phrases that say nothing about identity, in order of removal.
SUFFIXES = (
    "private limited company", "public limited company", "limited liability partnership", "community interest company",
    "limited", "ltd", "plc", "llp", "cic", "incorporated", "inc", "corporation", "corp", "company", "co", "group",
    "holdings", "uk", "international", "intl",
)
_WORD = r"[\p{L}\p{N}_]"
_START, _END = rf"(?<!{_WORD})", rf"(?!{_WORD})"
#: What separates a legal name from a trading name, in order of trial. A full stop is
#: no word character, so what follows "t.a." has to be one.
TRADING = (rf"{_START}t/a{_END}", rf"{_START}trading\s+as{_END}", rf"{_START}t\.a\.(?={_WORD})", rf"{_START}dba{_END}")
MAX_VARIANTS = 5
MIN_TOKEN = 2


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def strip_column(c: Column) -> Column:
    """strip() of a column: a text that begins and ends in visible ASCII is left as it is, without a pattern.
    The argument is used several times, so it should be a column."""
    visible = lambda ch: (ch > " ") & (ch < "\x7f")
    return F.when(visible(F.substring(c, 1, 1)) & visible(F.substring(c, -1, 1)), c).otherwise(strip(c))


def normalise(name: Column) -> Column:
    """Lower case, punctuation as space, suffix words removed, single spaces. Null gives ''."""
    lowered = F.lower(F.coalesce(name, F.lit("")))
    spaced = F.regexp_replace(lowered, r"(?U)[^\p{L}\p{N}_\s]", " ")
    bare = F.regexp_replace(spaced, f"{_START}(?:{'|'.join(SUFFIXES)}){_END}", " ")
    return F.trim(F.regexp_replace(bare, r"(?U)\s+", " "))


def trading_name(name: Column) -> Column:
    """What follows the first trading mark that is followed by anything; else null."""
    after = [F.nullif(strip(F.regexp_extract(name, rf"(?is){p}(.*)", 1)), F.lit("")) for p in TRADING]
    return F.coalesce(*after)


def _before_trading(name: Column) -> Column:
    """What comes before the first trading mark, in order of the marks."""
    out = F.lit(None).cast("string")
    for p in reversed(TRADING):
        out = F.when(name.rlike(f"(?i){p}"), strip(F.regexp_extract(name, rf"(?is)^(.*?){p}", 1))).otherwise(out)
    return out


def bracketed(name: Column) -> Column:
    """The name without brackets, if that is another, and the brackets' contents over two characters."""
    inside = F.filter(F.transform(F.regexp_extract_all(name, F.lit(r"\(([^)]+)\)"), F.lit(1)), strip), lambda x: F.length(x) > 2)
    outside = strip(F.regexp_replace(name, r"\([^)]*\)", ""))
    return F.when((outside != "") & (outside != strip(name)), F.concat(F.array(outside), inside)).otherwise(inside)


def split_parts(name: Column) -> Column:
    """Parts between -, / or | that stand between spaces."""
    return F.filter(F.transform(F.split(name, r"(?U)\s+[-/|]\s+"), strip), lambda x: x != "")


def variant_pairs(name: Column) -> Column:
    """Everything that may be asked for a name, as structs of text `v` and normalised form `n`: the
    whole name, then trading name, what comes before it, bracketed names and delimited parts."""
    whole = strip(F.coalesce(name, F.lit("")))
    traded = trading_name(name)
    extra = F.concat(
        F.when(traded.isNotNull(), F.array(traded, F.coalesce(_before_trading(name), F.lit("")))).otherwise(F.array().cast("array<string>")),
        bracketed(name),
        F.filter(split_parts(name), lambda x: x != whole),
    )
    pairs = F.filter(F.transform(extra, lambda v: F.struct(v.alias("v"), normalise(v).alias("n"))), lambda p: p["n"] != "")
    return F.concat(F.array(F.struct(whole.alias("v"), normalise(name).alias("n"))), pairs)


def distinct_variants(pairs: Column) -> Column:
    """At most five texts of variant_pairs(), the first of each normalised form; blank names: none.
    The argument is used several times, so it should be a column and no expression."""
    unique = F.filter(pairs, lambda p, i: F.array_position(F.transform(pairs, lambda q: q["n"]), p["n"]) == i + 1)
    return F.when(pairs[0]["v"] == "", F.array().cast("array<string>")).otherwise(F.slice(F.transform(unique, lambda p: p["v"]), 1, MAX_VARIANTS))


def variants(name: Column) -> Column:
    """Up to five query variants, different in normalised form; the whole name first. Blank: none."""
    return distinct_variants(variant_pairs(name))


def clean_variants(found: Column, name: Column) -> Column:
    """Stripped, unique, and the name itself where nothing is left."""
    kept = F.array_distinct(F.filter(F.transform(found, strip), lambda v: v != ""))
    return F.when(F.size(kept) == 0, F.array(name)).otherwise(kept)


def tokens_of_normalised(norm: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(F.split(norm, " "), lambda t: F.length(t) >= MIN_TOKEN)))


def tokens(name: Column) -> Column:
    """Sorted distinct words of the normalised name with two characters or more."""
    return tokens_of_normalised(normalise(name))


def bucket(token: Column) -> Column:
    """First letter a-z; '0-9' for digits; '_' for all else."""
    first = F.substring(F.coalesce(token, F.lit("")), 1, 1)
    return F.when(first.rlike(r"^[a-z]\z"), first).when(first.rlike(r"^\p{Nd}\z"), "0-9").otherwise("_")


def sort_key_of_normalised(norm: Column) -> Column:
    return F.array_join(F.array_sort(F.split(norm, " ")), " ")


def sort_key(name: Column) -> Column:
    """The normalised name's words in order, duplicates kept."""
    return sort_key_of_normalised(normalise(name))


def similarity_words(key: Column) -> Column:
    """The distinct words of a sort_key()."""
    return F.array_distinct(F.split(key, " "))


def characters(key: Column) -> Column:
    """A sort_key()'s characters in order."""
    return F.array_sort(F.filter(F.split(key, ""), lambda ch: ch != ""))


def similarity_letters(chars: Column) -> Column:
    """characters() as numbers that differ for each occurrence, so that sets of them intersect as
    the multisets do. The argument is used several times, so it should be a column."""
    return F.transform(chars, lambda ch, i: F.ascii(ch).cast("long") * F.lit(1 << 20) + i - F.array_position(chars, ch))


def with_similarity_keys(df: DataFrame, norm: str, words: str, letters: str) -> DataFrame:
    """df with what similarity_of() wants of the normalised name in column `norm`."""
    key = sort_key_of_normalised(F.col(norm))
    df = df.withColumns({words: similarity_words(key), letters: characters(key)})
    return df.withColumn(letters, similarity_letters(F.col(letters)))


def similarity_of(words_a: Column, letters_a: Column, words_b: Column, letters_b: Column) -> Column:
    """0.6 x Jaccard of the words + 0.4 x shared characters over the longer key; 0 if one is empty.
    Everything that depends on one name alone is computed once a name, never per pair."""
    common = F.size(F.array_intersect(words_a, words_b))
    jaccard = common / F.greatest(F.lit(1), F.size(words_a) + F.size(words_b) - common)
    overlap = F.size(F.array_intersect(letters_a, letters_b)) / F.greatest(F.size(letters_a), F.size(letters_b), F.lit(1))
    return F.when((F.size(letters_a) == 0) | (F.size(letters_b) == 0), F.lit(0.0)).otherwise(F.lit(0.6) * jaccard + F.lit(0.4) * overlap)


def similarities(pairs: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """pairs of normalised names (columns a and b) with their similarity in column `out`."""
    keyed = with_similarity_keys(with_similarity_keys(pairs, a, "_words_a", "_letters_a"), b, "_words_b", "_letters_b")
    return keyed.select(*pairs.columns, similarity_of(F.col("_words_a"), F.col("_letters_a"), F.col("_words_b"), F.col("_letters_b")).alias(out))


def similarity(a: Column, b: Column) -> Column:
    """The similarity of two names of any form."""
    x, y = sort_key(a), sort_key(b)
    return similarity_of(similarity_words(x), similarity_letters(characters(x)), similarity_words(y), similarity_letters(characters(y)))
