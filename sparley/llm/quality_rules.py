"""Quality rules, line first: drop lines that fail, then documents that lose too much.

A line fails if it holds no letter or digit, too many symbols and doubled marks, is a short
one that doesn't close (a heading, a button, an entry of a menu), is navigation (entries
between separators), or short boilerplate. A document goes that keeps too little.

Everything is a DataFrame expression; lines are split once and measured once. Defined
results: a null text has no words, fails the base rules and stays null when cleaned; lines
of white space only are neither judged nor counted; repeated rows are judged alike; extra
columns pass through `clean`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, WHITE_RUN, WORD

SYMBOLS = "#*$%&|<>"
#: A line fails the punctuation rule over this share of symbols and doubled marks among its characters.
MARKS, MOST_MARKS = "#*$%&|<>{}\\^~=_", 0.08
#: A line of at most so many words has to end with one of these, quotes and brackets behind it aside.
OPEN_WORDS = 20
CLOSING = r"""[.!?…:;。！？]["'”’»«)\]]*[\x20\x09-\x0D]*$"""
#: A line of at least this many separators, one in five words or more, is navigation.
NAVIGATION, SEPARATORS, SEPARATOR_WORDS = "|»›·•→", 2, 5
#: A document is rejected that keeps a smaller share of the characters of its words.
LEAST_KEPT = 0.5
#: Phrases, lower-case, that mark a line of at most BOILERPLATE_CHARS characters as
#: boilerplate: rights, consent, scripts, calls to read, share or subscribe, in English, German,
#: Spanish and French.
BOILERPLATE = (
    "accept all cookies",
    "all rights reserved",
    "click here",
    "cookie policy",
    "enable javascript",
    "javascript is disabled",
    "lorem ipsum",
    "privacy policy",
    "read more",
    "share this article",
    "sign up for our newsletter",
    "skip to content",
    "subscribe to our newsletter",
    "terms of service",
    "terms of use",
    "alle rechte vorbehalten",
    "cookies akzeptieren",
    "datenschutzerkl",
    "hier klicken",
    "javascript aktivieren",
    "mehr lesen",
    "newsletter abonnieren",
    "nutzungsbedingungen",
    "zum inhalt springen",
    "aceptar todas las cookies",
    "haga clic aqu",
    "habilite javascript",
    "ir al contenido",
    "leer más",
    "política de cookies",
    "política de privacidad",
    "todos los derechos reservados",
    "términos de uso",
    "accepter tous les cookies",
    "activez javascript",
    "aller au contenu",
    "cliquez ici",
    "conditions d'utilisation",
    "lire la suite",
    "politique de confidentialité",
    "tous droits réservés",
)
BOILERPLATE_CHARS = 200


def word_hashes(text: Column) -> Column:
    stripped = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    words = F.when(stripped == "", F.array().cast("array<string>")).otherwise(F.split(stripped, WHITE_RUN))
    return F.transform(words, lambda w: F.xxhash64(w))


def _held(line: Column, characters: str) -> Column:
    return F.length(line) - F.length(F.translate(line, characters, ""))


def line_passes(line: Column, chars: Column) -> Column:
    """The rules on one line that has a word; chars: its characters that aren't white space."""
    words = F.regexp_count(line, F.lit(WORD))
    doubled = reduce(Column.__or__, (line.contains(x) for x in ("!!", "!?", "?!", "??")))
    marks = _held(line, MARKS) + F.when(doubled, F.regexp_count(line, F.lit("[!?]{2,}"))).otherwise(F.lit(0))
    closes = line.rlike(CLOSING) | (words > OPEN_WORDS)
    separators = _held(line, NAVIGATION)
    navigation = (separators >= SEPARATORS) & (separators * SEPARATOR_WORDS >= words)
    boilerplate = (F.length(line) <= BOILERPLATE_CHARS) & reduce(Column.__or__, (F.lower(line).contains(x) for x in BOILERPLATE))
    speaks = line.rlike(r"[\p{L}\p{N}]")
    return (marks <= MOST_MARKS * chars) & closes & ~navigation & ~boilerplate & speaks


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, x: a + x)


def _once(value: Column) -> Column:
    """value, as a column that the optimiser neither copies into the lambdas that read it
    nor pushes below a filter, where it would be computed again for every element."""
    return F.when(F.monotonically_increasing_id() >= 0, value)


def judge(docs: DataFrame) -> DataFrame:
    """docs and the columns n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    kept_chars, clean_text, base_failed and kept.

    The text must be in a column `text`; columns of those names are replaced.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    measured = F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("line"), F.length(F.translate(x, WHITE, "")).alias("chars")))
    a = docs.select("*", _once(word_hashes(F.col("text"))).alias("__rules_h"), _once(measured).alias("__rules_all"))
    a = a.withColumn("__rules_lines", _once(F.transform(F.filter(F.coalesce("__rules_all", F.array().cast("array<struct<line:string,chars:int>>")), lambda x: x.chars > 0), lambda x: x.line)))
    # Three-word windows, as one hash each.
    n = F.size("__rules_h")
    windows = F.when(n >= 3, F.transform(F.slice("__rules_h", 1, F.greatest(n - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get("__rules_h", i + 1), F.get("__rules_h", i + 2)))).otherwise(F.array().cast("array<bigint>"))
    b = a.select("*", _once(windows).alias("__rules_w"))
    # Only where a window recurs: sort windows with their positions, so that equal ones are neighbours.
    order = F.when(
        F.size(F.array_distinct("__rules_w")) < F.size("__rules_w"),
        F.sort_array(F.transform("__rules_w", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    c = b.select("*", _once(order).alias("__rules_s"))
    again = F.filter(
        F.transform("__rules_s", lambda x, j: F.when((x.h == F.get("__rules_s", j - 1).h) | (x.h == F.get("__rules_s", j + 1).h), x.i)),
        lambda i: i.isNotNull(),
    )
    d = c.select("*", _once(F.sort_array(again)).alias("__rules_p"))
    repeats = _sum(F.transform("__rules_p", lambda x, j: F.least(F.lit(3), F.coalesce(F.get("__rules_p", j + 1) - x, F.lit(3))).cast("long")))
    chars = lambda x: F.length(F.translate(x, WHITE, "")).cast("long")
    cleaned = F.transform(F.filter("__rules_all", lambda x: (x.chars == 0) | line_passes(x.line, x.chars)), lambda x: x.line)
    new = {
        "n_words": n.cast("long"),
        "word_chars": chars(text),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size("__rules_lines") - F.size(F.array_distinct("__rules_lines"))).cast("long"),
        "n_repeat_words": F.coalesce(repeats, F.lit(0)).cast("long"),
        "clean_text": F.array_join(cleaned, "\n"),
    }
    e = d.withColumns({k: _once(v) for k, v in new.items()})
    e = e.withColumn("kept_chars", F.coalesce(chars(F.col("clean_text")), F.lit(0).cast("long")))
    e = e.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    e = e.withColumn("kept", ~F.col("base_failed") & (F.col("kept_chars") >= LEAST_KEPT * F.col("word_chars")))
    return e.drop("__rules_h", "__rules_all", "__rules_lines", "__rules_w", "__rules_s", "__rules_p")


def clean(docs: DataFrame) -> DataFrame:
    """The documents that pass, without the lines that fail; the same columns as docs, n_chars
    counted anew."""
    rows = docs.select(F.struct(*docs.columns).alias("__rules_row"), "text")
    out = judge(rows).filter("kept")
    own = {c: F.col("__rules_row")[c] for c in docs.columns} | {"text": F.col("clean_text")}
    if "n_chars" in own:
        own["n_chars"] = F.length("clean_text").cast(docs.schema["n_chars"].dataType)
    return out.select(*(value.alias(c) for c, value in own.items()))
