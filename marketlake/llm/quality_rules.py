"""Line-first cleaning: rules on each line take out failing lines; a text that loses too much of itself is rejected.

Built-in functions only. Everything about a text is worked out in its own row, so nothing is shuffled.

Cases: a null or empty text has no words, fails the base rules and is not kept. Repeated rows give repeated rows. A text
of any length is read whole. Extra columns are dropped; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"

#: Rules of a line, as patterns that mean the same to Java and RE2, judged by shares of the line's words. A line fails with
#: fewer than one sentence end in WORDS_A_SENTENCE words, or none; with MARKS marks of a kind or more (repeated exclamation,
#: separators of menus, runs of symbols) that are more than one in WORDS_A_MARK words; or as boilerplate, if it is short.
ENDS = r"""[.!?:;…。！？]+["')\]”’»]*([\x20\x09-\x0D]|\z)"""
WORDS_A_SENTENCE = 100
SHOUTS, NAVIGATES, SYMBOLIC = r"[!?]{2,}", r"[|›•>]", r"[#*$%&<>]{2,}"
MARKS, WORDS_A_MARK = 3, 4
BOILERPLATE = (
    r"(?i)(all rights reserved|copyright \(c\)|cookie policy|privacy policy|terms of (use|service)|enable javascript|"
    r"subscribe to our|sign up for|click here|read more|log ?in to|licensed under the|lorem ipsum|powered by|"
    r"alle rechte vorbehalten|datenschutzerkl[äÄ]rung|cookie-richtlinie|hier klicken|mehr lesen|newsletter abonnieren|"
    r"tous droits r[éÉ]serv[éÉ]s|politique de confidentialit[éÉ]|mentions l[éÉ]gales|cliquez ici|lire la suite|abonnez-vous|"
    r"todos los derechos reservados|pol[íÍ]tica de (privacidad|cookies)|aviso legal|haga clic aqu[íÍ]|leer m[áÁ]s|suscr[íÍ]bete)"
)
BOILERPLATE_CHARS = 200
MIN_KEPT = 0.5
MIN_WORDS = 50


def _let(value: Column, body) -> Column:
    """`body(value)`, with the value worked out once a row however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _repeated(hashes: Column) -> Column:
    """Words in 3-word windows that occur twice or more, from the windows' hashes by place."""
    tagged = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def spread(rows: Column) -> Column:
        def twice(x: Column, k: Column) -> Column:
            return F.coalesce(F.get(rows, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(rows, k + 1)["h"] == x["h"], F.lit(False))

        places = F.transform(F.filter(rows, twice), lambda x: F.sequence(x["i"], x["i"] + 2))
        return F.size(F.array_distinct(F.flatten(places)))

    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(_let(tagged, spread))


def _windows(words: Column) -> Column:
    """Hashes of the 3-word windows. A text of n words errs with odds of about n * n / 2**65."""
    places = F.sequence(F.lit(0), F.size(words) - 3)
    window = F.transform(places, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) >= 3, window).otherwise(F.array().cast("array<bigint>"))


def line_passes(line: Column) -> Column:
    """Whether a line is kept. Words and ends are counted only where a text of that length could fail by their share."""
    words = F.size(F.array_remove(F.split(line, f"{SPACE}+"), ""))
    short = F.length(line) <= 2 * WORDS_A_SENTENCE  # as many words at most as one end is enough for
    ends = line.rlike(ENDS) & (short | (WORDS_A_SENTENCE * F.regexp_count(line, F.lit(ENDS)) >= words))
    marked = [line.rlike(f"(?s)({p})(.*({p})){{{MARKS - 1}}}") & (WORDS_A_MARK * F.regexp_count(line, F.lit(p)) > words) for p in (SHOUTS, NAVIGATES, SYMBOLIC)]
    return ends & ~marked[0] & ~marked[1] & ~marked[2] & ~((F.length(line) <= BOILERPLATE_CHARS) & line.rlike(BOILERPLATE))


def clean_lines(documents: DataFrame, min_kept: float = MIN_KEPT, min_words: int = MIN_WORDS) -> DataFrame:
    """Base counts, `base_failed`, the text of the lines that pass, how much of the words it keeps, and the verdict."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select("doc_id", text.alias("text"))
    rows = rows.select(
        "doc_id",
        "text",
        F.array_remove(F.split("text", f"{SPACE}+"), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(NOT_SPACE)).alias("lines"),
    )
    rows = rows.select(
        "doc_id",
        "text",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", f"{SYMBOLS}+", ""))).cast("long").alias("n_symbols"),
        "lines",
        _let(_windows(F.col("words")), _repeated).cast("long").alias("n_repeat_words"),
        F.filter("lines", line_passes).alias("passed"),
    )
    rows = rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        ((F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).alias("base_failed"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size("passed").cast("long").alias("kept_lines"),
        F.length(F.regexp_replace(F.array_join("passed", ""), f"{SPACE}+", "")).cast("long").alias("kept_chars"),
        F.array_join("passed", "\n").alias("clean_text"),
    )
    verdict = F.col("kept_chars") >= F.lit(min_kept) * F.col("word_chars")
    return rows.withColumn("kept", ~F.col("base_failed") & verdict)
