"""Quality rule by distribution divergence (operator 1), native DataFrame operations only.

A document is described by two histograms: its characters by class, and its
occurrences of common words.  Each is compared with the histogram of every
reference language by Jensen-Shannon distance (square root of the
divergence, base 2, so 0 to 1); the nearest language counts.  A document is
rejected when a distance is above its threshold.  Minimum-length guards
leave short evidence unjudged: a histogram of fewer than ``min_chars``
characters or ``min_common`` common words decides nothing.

The references are the summed histograms of all documents of each language:
one row for each configured language, so what reaches the driver is bounded
by the configuration.

Results: a null text has no words and no lines, and fails the base rule; a
document whose language is null or unknown is compared as any other but adds
to no reference; a language without documents is left out, and with no
references at all the method rejects nothing; repeated rows are judged one
by one; columns of the input other than id, text and language are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimspark.llm.store import written

WORD_GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MARKS = ".,;:!?"

#: Frequent function words of each reference language.
COMMON_WORDS = {
    "de": ("das", "der", "die", "ist", "mit", "nicht", "sich", "und", "von", "zu"),
    "en": ("and", "for", "in", "is", "of", "that", "the", "this", "to", "was"),
    "es": ("de", "del", "el", "en", "la", "los", "que", "se", "un", "y"),
    "fr": ("dans", "des", "en", "est", "et", "la", "le", "les", "pour", "une"),
}
#: Character classes, each taken from what the classes before it leave.
CLASSES = (("lower", r"\p{Ll}+"), ("upper", r"\p{Lu}+"), ("space", r"[\x20\x09-\x0D]+"),
           ("sentence", r"[.,;:!?'\"()-]+"), ("digit", r"\p{Nd}+"), ("letter", r"\p{L}+"))


@dataclass(frozen=True)
class Settings:
    words: dict[str, Sequence[str]] = field(default_factory=lambda: COMMON_WORDS)
    min_words: int = 50
    max_repeat_percent: int = 50
    min_chars: int = 200
    min_common: int = 20
    max_class_distance: float = 0.25
    max_word_distance: float = 0.6


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def _with_repeated_words(df: DataFrame) -> DataFrame:
    """Add ``n_repeat_words``: the words inside 3-word windows that occur twice or more.

    Sorted hashes of the windows show which hashes repeat.  Windows of those
    hashes are sorted as texts with their places; those equal to a neighbour
    are repeated, and each gap between their places adds at most three words.
    Each step is a column that later ones name more than once, so the
    optimiser computes it once.
    """
    starts = F.when(F.size("words") >= 4, F.sequence(F.lit(0), F.size("words") - 3)).otherwise(
        F.array().cast("array<int>"))
    df = df.withColumn("hashes", F.transform(starts, lambda i: F.xxhash64(
        F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))))
    df = df.withColumn("sorted", F.sort_array("hashes"))
    df = df.withColumn("repeated", F.array_distinct(F.filter(
        "sorted", lambda h, i: (i > 0) & (h == F.get("sorted", i - 1)))))
    # A lookup in few repeated hashes is cheap; beyond that all windows are sorted, with the same result.
    all_starts = F.sequence(F.lit(0), F.size("hashes") - 1)
    chosen = (F.when(F.size("repeated") == 0, F.array().cast("array<int>"))
              .when(F.size("repeated") <= 64, F.filter(
                  all_starts, lambda i: F.array_contains(F.col("repeated"), F.get("hashes", i))))
              .otherwise(all_starts))
    df = df.withColumn("windows", F.sort_array(F.transform(chosen, lambda i: F.struct(
        F.concat_ws(" ", F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)).alias("w"),
        i.alias("at")))))

    def same(i: Column, j: Column) -> Column:
        return F.coalesce(F.get("windows", i)["w"] == F.get("windows", j)["w"], F.lit(False))

    places = F.sort_array(F.transform(
        F.filter("windows", lambda _, i: same(i, i - 1) | same(i, i + 1)), lambda x: x["at"]))
    covered = F.aggregate(places, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")), lambda a, x: F.struct(
        (a["n"] + F.least(F.lit(3), x - a["last"])).alias("n"), x.alias("last")))["n"]
    return (df.withColumn("n_repeat_words", F.when(F.size("windows") < 2, F.lit(0)).otherwise(covered).cast("long"))
            .drop("hashes", "sorted", "repeated", "windows"))


def features(docs: DataFrame, settings: Settings, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """One row for each document: base counts, the class counts and the common words with their counts."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    common = sorted({w for ws in settings.words.values() for w in ws})
    out = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), text.alias("text"),
                      F.filter(F.split(text, WORD_GAP), lambda w: w != "").alias("words"))
    out = _with_repeated_words(out)
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(F.translate(x, " \t\x0b\x0c\r", "")) > 0)
    # Each class is cut from what the classes before it leave; the last class is whatever is left.
    # A step reads its predecessor twice, so the optimiser keeps the steps apart and each runs once.
    out = out.withColumn("rest0", F.col("text"))
    for i, (_, pattern) in enumerate(CLASSES):
        out = out.withColumn(f"rest{i + 1}", F.regexp_replace(f"rest{i}", pattern, ""))
    lengths = [F.length(f"rest{i}").cast("double") for i in range(len(CLASSES) + 1)]
    classes = F.array(*[n - after for n, after in zip(lengths, [*lengths[1:], F.lit(0.0)], strict=True)])
    # A common word counts in lower case or capitalised, alone or before one mark; the set has a fixed size.
    written_as = sorted({form + mark for w in common for form in (w, w.capitalize()) for mark in ("", *MARKS)})
    used = F.transform(F.filter("words", lambda w: w.isin(written_as)),
                       lambda w: F.lower(F.translate(w, MARKS, "")))

    def counted(s: Column) -> Column:
        """Sorted words as (word, count): each run's start, and the next run's."""
        starts = F.filter(F.sequence(F.lit(1), F.size(s)),
                          lambda i: (i == 1) | (F.element_at(s, i) != F.get(s, i - 2)))
        return _let(starts, lambda r: F.transform(r, lambda x, i: F.struct(
            F.element_at(s, x).alias("w"),
            (F.coalesce(F.get(r, i + 1), F.size(s) + 1) - x).cast("double").alias("n"))))

    return out.select(
        "doc_id", "lang",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        _let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
        "n_repeat_words",
        classes.alias("classes"),
        _let(F.sort_array(used), lambda s: F.when(F.size(s) > 0, counted(s)).otherwise(
            F.array().cast("array<struct<w:string,n:double>>"))).alias("common"),
    )


@dataclass(frozen=True)
class Reference:
    """Shares of one language, over the character classes and over the common words."""

    classes: tuple[float, ...]
    words: dict[str, float]


def references(found: DataFrame, settings: Settings) -> dict[str, Reference]:
    """The histogram of each configured language over all its documents' features (a bounded number of rows)."""
    found = found.where(F.col("lang").isin(sorted(settings.words)))
    numbered = F.transform("classes", lambda n, i: F.struct(i.cast("string").alias("w"), n.alias("n")))
    # Sums combine in each task before the shuffle, so a language with most rows sends as few as any.
    rows = (found.select("lang", F.explode(F.array(
                F.struct(F.lit("class").alias("kind"), numbered.alias("bins")),
                F.struct(F.lit("word").alias("kind"), F.col("common").alias("bins")))).alias("h"))
            .select("lang", "h.kind", F.explode("h.bins").alias("bin"))
            .groupBy("lang", "kind", "bin.w").agg(F.sum("bin.n").alias("n")).collect())
    out = {}
    for lang in sorted({row["lang"] for row in rows}):
        of = {kind: {r["w"]: r["n"] for r in rows if (r["lang"], r["kind"]) == (lang, kind) and r["n"]}
              for kind in ("class", "word")}
        shares = {kind: {w: n / sum(bins.values()) for w, n in bins.items()} for kind, bins in of.items()}
        if shares["class"]:
            out[lang] = Reference(tuple(shares["class"].get(str(i), 0.0) for i in range(len(CLASSES) + 1)),
                                  shares["word"])
    return out


def _half(p: Column, q: Column) -> Column:
    """p log2(p / mean of p and q), 0 where p is 0."""
    return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(F.lit(0.0))


def _distance(divergence: Column) -> Column:
    return F.sqrt(F.greatest(F.lit(0.0), divergence / 2))


def class_distance(counts: Column, reference: Reference) -> Column:
    def divergence(total: Column) -> Column:
        shares = F.array(*[F.lit(q) for q in reference.classes])
        terms = F.zip_with(F.transform(counts, lambda n: n / total), shares, lambda p, q: _half(p, q) + _half(q, p))
        return F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    return _distance(_let(F.aggregate(counts, F.lit(0.0), lambda a, x: a + x), divergence))


def word_distance(common: Column, reference: Reference) -> Column:
    """A word that the document lacks adds its whole share, so only its own words are visited."""
    if not reference.words:
        return F.lit(1.0)
    share = F.create_map(*[F.lit(v) for pair in sorted(reference.words.items()) for v in pair])

    def divergence(total: Column) -> Column:
        pairs = F.transform(common, lambda x: F.struct(
            (x["n"] / total).alias("p"), F.coalesce(share[x["w"]], F.lit(0.0)).alias("q")))
        return F.aggregate(pairs, F.lit(1.0),
                           lambda a, x: a + _half(x["p"], x["q"]) + _half(x["q"], x["p"]) - x["q"])
    return _distance(_let(F.aggregate(common, F.lit(0.0), lambda a, x: a + x["n"]), divergence))


def judge(docs: DataFrame, settings: Settings | None = None, refs: dict[str, Reference] | None = None,
          **columns: str) -> DataFrame:
    """One row for each document: base counts, ``base_failed``, both distances and ``kept``.

    The features are written once; the references and the verdicts both read
    them, so texts are read in one pass.
    """
    settings = settings or Settings()
    f = written(features(docs, settings, **columns), "distribution")
    refs = references(f, settings) if refs is None else refs

    def nearest(of: Callable[[Reference], Column]) -> Column:
        each = [of(r) for _, r in sorted(refs.items())]
        return F.lit(None).cast("double") if not each else F.least(*each) if len(each) > 1 else each[0]

    chars = F.aggregate("classes", F.lit(0.0), lambda a, x: a + x)
    commons = F.aggregate("common", F.lit(0.0), lambda a, x: a + x["n"])
    base_failed = ((F.col("n_words") < settings.min_words)
                   | (100 * F.col("n_repeat_words") > settings.max_repeat_percent * F.col("n_words")))
    out = f.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"),
        F.when(chars >= settings.min_chars, nearest(lambda r: class_distance(F.col("classes"), r)))
        .alias("class_distance"),
        F.when(commons >= settings.min_common, nearest(lambda r: word_distance(F.col("common"), r)))
        .alias("word_distance"))
    fits = (F.coalesce(F.col("class_distance") <= settings.max_class_distance, F.lit(True))
            & F.coalesce(F.col("word_distance") <= settings.max_word_distance, F.lit(True)))
    return out.withColumn("kept", ~F.col("base_failed") & fits)
