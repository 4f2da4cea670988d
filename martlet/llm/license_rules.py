"""License scan: ordered regular expressions behind keyword gates, overlaps settled by priority.

The signatures stand in ``license_signatures.txt``, one hand-written regular expression a line
with label, priority, weight and a keyword. For the labels of ``SPDX_IDS`` and ``GRANT_TITLES``
two more signatures each are built: the machine-readable ``SPDX-License-Identifier`` tag
(priority 4) and the grant "licensed under the ..." around the title (priority 3).

A space in a pattern or keyword stands for any run of white space, and ``.`` for any character or such a run. Detection
therefore works on texts with each run folded to one space, so line breaks and indents hide nothing; places and
copies are those of the folded texts. The base phrases and word counts are not affected.

A text is scanned only if it holds one of the gate words (looked for as plain substrings first, then as the gate's expression), and a signature is tried only if the text
holds its keyword. A detection is suppressed if its interval lies within that of a detection of higher
priority, or of the same priority and longer, or with the same interval and an earlier signature. The
labels are those of the detections left, together with those of the base phrases.
"""

from __future__ import annotations

import re
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.llm.shared import ascii_lower, stored

PHRASES = {
    "apache": "apache license",
    "cc-by": "cc by",
    "gpl": "gnu general public license",
    "mit": "mit license",
}
PRIORITIES = (1, 2, 3, 4)
SPDX_IDS = {
    "mit": r"mit", "mit-0": r"mit-0", "isc": r"isc", "0bsd": r"0bsd", "zlib": r"zlib", "libpng": r"libpng(?:-2\.0)?",
    "bsd-2-clause": r"bsd-2-clause", "bsd-3-clause": r"bsd-3-clause", "bsd-4-clause": r"bsd-4-clause",
    "apache-2.0": r"apache-2\.0", "apache-1.1": r"apache-1\.1", "gpl-2.0": r"gpl-2\.0(?:-only|-or-later|\+)?",
    "gpl-3.0": r"gpl-3\.0(?:-only|-or-later|\+)?", "lgpl-2.1": r"lgpl-2\.1(?:-only|-or-later|\+)?",
    "lgpl-3.0": r"lgpl-3\.0(?:-only|-or-later|\+)?", "agpl-3.0": r"agpl-3\.0(?:-only|-or-later|\+)?",
    "gfdl": r"gfdl-1\.[123](?:-only|-or-later)?", "mpl-1.1": r"mpl-1\.1", "mpl-2.0": r"mpl-2\.0", "epl-1.0": r"epl-1\.0",
    "epl-2.0": r"epl-2\.0", "cddl-1.0": r"cddl-1\.0", "cddl-1.1": r"cddl-1\.1", "cpl-1.0": r"cpl-1\.0", "cpal-1.0": r"cpal-1\.0",
    "ipl-1.0": r"ipl-1\.0", "apsl-2.0": r"apsl-2\.0", "ms-pl": r"ms-pl", "ms-rl": r"ms-rl", "osl-3.0": r"osl-3\.0",
    "afl-3.0": r"afl-3\.0", "artistic-1.0": r"artistic-1\.0", "artistic-2.0": r"artistic-2\.0", "python-2.0": r"(?:python|psf)-2\.0",
    "php-3.01": r"php-3\.01", "ruby": r"ruby", "w3c": r"w3c", "unlicense": r"unlicense", "wtfpl": r"wtfpl", "boost": r"bsl-1\.0",
    "ncsa": r"ncsa", "postgresql": r"postgresql", "openssl": r"openssl", "curl": r"curl", "x11": r"x11", "vim": r"vim",
    "eupl-1.1": r"eupl-1\.1", "eupl-1.2": r"eupl-1\.2", "cecill": r"cecill-(?:[12]\.[01]|b|c)", "ofl-1.1": r"ofl-1\.1",
    "odbl": r"odbl-1\.0", "odc-by": r"odc-by-1\.0", "pddl": r"pddl-1\.0", "ogl-uk": r"ogl-uk-[123]\.0", "sspl-1.0": r"sspl-1\.0",
    "busl-1.1": r"busl-1\.1", "elastic-2.0": r"elastic-2\.0", "cc-by": r"cc-by-[1-4]\.0", "cc-by-sa": r"cc-by-sa-[1-4]\.0",
    "cc-by-nc": r"cc-by-nc-[1-4]\.0", "cc-by-nd": r"cc-by-nd-[1-4]\.0", "cc-by-nc-sa": r"cc-by-nc-sa-[1-4]\.0",
    "cc-by-nc-nd": r"cc-by-nc-nd-[1-4]\.0", "cc0": r"cc0-1\.0",
}

GRANT_TITLES = {
    "mit": r"mit", "isc": r"isc", "bsd": r"bsd", "bsd-2-clause": r"(?:2-clause bsd|bsd 2-clause)", "bsd-3-clause": r"(?:3-clause bsd|bsd 3-clause)",
    "zlib": r"zlib", "apache-2.0": r"apache(?: licen[cs]e,?)?(?: version)? 2(?:\.0)?", "gpl-2.0": r"(?:gnu )?gpl ?v?2(?:\.0)?",
    "gpl-3.0": r"(?:gnu )?gpl ?v?3(?:\.0)?", "gpl": r"gnu general public", "lgpl": r"gnu lesser general public", "agpl": r"gnu affero general public",
    "mpl-2.0": r"(?:mozilla public|mpl) ?(?:licen[cs]e )?v?2\.0", "epl": r"eclipse public", "unlicense": r"unlicen[cs]e", "boost": r"boost software",
    "ofl-1.1": r"sil open font", "odbl": r"open database", "cc-by": r"(?:cc[ -]by|creative commons attribution)(?: [1-4]\.0)?",
    "cc-by-sa": r"cc[ -]by[ -]sa(?: [1-4]\.0)?", "cc-by-nc": r"cc[ -]by[ -]nc(?: [1-4]\.0)?", "cc-by-nd": r"cc[ -]by[ -]nd(?: [1-4]\.0)?",
    "cc0": r"cc0(?: 1\.0)?", "artistic-2.0": r"artistic(?: licen[cs]e)? 2\.0", "eupl-1.2": r"(?:eupl|european union public)", "ms-pl": r"microsoft public",
}

_GRANT = r"(?:licen[cs]ed|released|distributed|published|available|provided|made available) under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?"


WHITE = r"[\s\p{Z}\x85\x1C-\x1F]+"
# a class without a space at its start; one with a space, and its rest; an optional space; a space; any character
_SPACES = re.compile(r"(\[[^ ][^\]]*\])|\[ ([^\]]+)\](\?)?|( \?)|( )|((?<!\\)\.)")


def _on_any_text(pattern: str) -> str:
    """The pattern with its spaces matching any white-space run."""

    def wide(m: re.Match) -> str:
        if m[1]:
            return m[1]
        if m[2]:
            return rf"(?:\s+|[{m[2]}]){m[3] or ''}"
        return r"\s*" if m[4] else r"\s+" if m[5] else r"(?:\s+|\S)"

    return _SPACES.sub(wide, pattern)


def folded(text: Column) -> Column:
    """The text with each run of white space as one space."""
    return F.regexp_replace(text, WHITE, " ")


def _on_folded(pattern: str) -> str:
    """A pattern for any text as one for folded texts, where a run is one space."""
    return pattern.replace(r"(?:\s+|\S)", "(?s:.)").replace(r"\s+", " ").replace(r"\s*", " ?")


@cache
def build_signatures() -> tuple[tuple[int, str, int, float, str, str], ...]:
    """(order, label, priority, weight, keyword, pattern), in the order in which they rank; the patterns are for any text."""
    found = [(label, 4, 1.0, "spdx-license-identifier", rf"spdx-license-identifier:\s*\(?{tag}(?![\w.-])") for label, tag in SPDX_IDS.items()]
    found += [(label, 3, 1.0, " under ", rf"{_GRANT}{title}(?:\s+licen[cs]e)?(?![\w-])") for label, title in GRANT_TITLES.items()]
    for line in Path(__file__).with_name("license_signatures.txt").read_text("utf-8").splitlines():
        if line and not line.startswith("#"):
            label, priority, weight, keyword, pattern = (x.strip() for x in line.split("|", 4))
            found.append((label, int(priority), float(weight), keyword, pattern))
    return tuple((i, *x[:-1], _on_any_text(x[-1])) for i, x in enumerate(found))


def _rules() -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(i).alias("rule"), F.lit(label).alias("label"), F.lit(p).alias("priority"),
                F.lit(w).alias("weight"), F.lit(kw).alias("keyword"), F.lit(_on_folded(rx)).alias("pattern"),
            )
            for i, label, p, w, kw, rx in build_signatures()
        ]
    )


GATE_PATTERN = (
    "licen[cs]|(?:ed|able) under |\\b0?bsd|gpl|\\bcc[0 -]|cecill|eupl|zlib|wtfpl|mit-0|mit no attr|opensource\\.org|(?:apache|gnu|mozilla|eclipse|boost|creativecommons|sil)\\.org|"
    "open ?rail|public domain|rights reserved|rechte vorbehalten|tous droits|todos los derechos|permission|redistribution and use|neither the name|"
    "all advertising materials|altered source versions|same terms as perl|used for good|invariant sections|terms of the mozilla|"
    "proprietary|research purposes|non-commercial|personal use|commons attribution|ofl"
)


#: Every text that the gate's expression matches holds one of these, whatever its white space is.
GATE_WORDS = (
    "licen", "under", "bsd", "gpl", "cecill", "eupl", "zlib", "wtfpl", "mit-0", "attr", ".org", "rail", "domain", "reserved", "vorbehalten",
    "droits", "derechos", "permission", "redistribution", "neither", "advertising", "altered", "perl", "good", "invariant", "mozilla",
    "proprietary", "purposes", "non-commercial", "personal", "ofl",
)


def gated(lower: Column) -> Column:
    """Whether a lower-cased text may hold a signature: plain searches first, the folded text and the expression only for what they leave."""
    some = F.contains(lower, F.lit("cc")) & lower.rlike(r"\bcc[0\s\p{Z}\x85\x1C-\x1F-]")
    for word in GATE_WORDS:
        some = some | F.contains(lower, F.lit(word))
    return some & folded(lower).rlike(GATE_PATTERN)


def lowered(text: Column) -> Column:
    """A-Z in lower case; also other letters, but for those that would become ASCII ones."""
    return F.when(F.contains(text, F.lit("\u212a")) | F.contains(text, F.lit("\u0130")), ascii_lower(text)).otherwise(F.lower(text))


def word_text(lower: Column) -> Column:
    """The words joined and enclosed by one space each; one space if there are none."""
    inner = F.trim(F.regexp_replace(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))
    return F.when(inner == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), inner, F.lit(" ")))


def detect(texts: DataFrame) -> DataFrame:
    """Detections left after suppression for a frame (text_key, lower) of distinct folded texts.

    (text_key, start, end, rule, label, priority, weight); start and end count characters. The
    places of a signature follow from the lengths of what lies between its matches, so the work
    grows with the number of matches.
    """
    rules = F.filter(_rules(), lambda r: F.contains(F.col("lower"), r["keyword"]))
    tried = texts.select("text_key", "lower", F.explode(rules).alias("r"))
    pieces = tried.select(
        "text_key",
        "r",
        F.split("lower", F.col("r.pattern"), -1).alias("between"),
        F.regexp_extract_all("lower", F.col("r.pattern"), F.lit(0)).alias("matched"),
    ).filter(F.size("matched") > 0)
    hits = pieces.select(
        "text_key",
        F.col("r.rule").alias("rule"),
        F.col("r.label").alias("label"),
        F.col("r.priority").alias("priority"),
        F.col("r.weight").alias("weight"),
        F.posexplode(
            F.transform(
                F.arrays_zip(F.slice("between", 1, F.size("matched")).alias("b"), F.col("matched").alias("m")),
                lambda x: F.struct(F.char_length(x["b"]).cast("long").alias("gap"), F.char_length(x["m"]).cast("long").alias("len")),
            )
        ).alias("nth", "x"),
    )
    so_far = Window.partitionBy("text_key", "rule").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    placed = hits.repartition("text_key").withColumn("end", F.sum(F.col("x.gap") + F.col("x.len")).over(so_far))
    placed = placed.withColumn("start", F.col("end") - F.col("x.len"))
    # containers come first: earlier start, then later end, then higher priority, then earlier signature
    before = (
        Window.partitionBy("text_key")
        .orderBy("start", F.desc("end"), F.desc("priority"), "rule")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    reach = placed.select("*", *[F.max(F.when(F.col("priority") >= p, F.col("end"))).over(before).alias(f"reach{p}") for p in PRIORITIES])
    covered = F.coalesce(*[F.when(F.col("priority") == p, F.coalesce(F.col(f"reach{p}") >= F.col("end"), F.lit(False))) for p in PRIORITIES])
    return reach.filter(~covered).select("text_key", "start", "end", "rule", "label", "priority", "weight")


def scan(docs: DataFrame) -> DataFrame:
    """One row per document with its words, base phrases, labels and score.

    doc_id, n_words, n_base, first_word, last_word, base_labels, labels, n_detections, score. Null
    and empty texts have no words, empty label lists and score 0; repeated rows get equal results
    each; other columns are ignored; an empty table gives no rows. The score is the largest weight of the labels
    found (a base phrase weighs 0.9), 0 without any. Texts that pass the gate are scanned once per distinct
    text (by SHA-256), so a group of copies costs as much as one text.
    """
    asked = docs.select("doc_id", lowered(F.coalesce("text", F.lit(""))).alias("lower"))
    words = F.regexp_count("lower", F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")).cast("long")
    any_phrase = "(?:" + "|".join(PHRASES.values()) + ")(?= )"
    by = F.contains(F.col("lower"), F.lit("cc")) & F.col("lower").rlike(r"cc[\x00-\x2F\x3A-\x60\x7B-\x7F]+by")
    base_gate = F.contains(F.col("lower"), F.lit("license")) | by
    spaces = lambda s: (F.char_length(s) - F.char_length(F.replace(s, F.lit(" "), F.lit("")))).cast("long")
    row = asked.select(
        "doc_id",
        words.alias("n_words"),
        F.when(base_gate, word_text(F.col("lower"))).alias("_norm"),
        F.when(gated(F.col("lower")), folded(F.col("lower"))).alias("_folded"),
    ).withColumn("n_base", F.coalesce(F.regexp_count("_norm", F.lit(" " + any_phrase)), F.lit(0)).cast("long"))
    found = F.col("n_base") > 0
    row = row.select(
        "doc_id",
        "n_words",
        "n_base",
        F.when(found, spaces(F.regexp_extract("_norm", f"(?s)^(.*?) {any_phrase}", 1))).alias("first_word"),
        F.when(found, spaces(F.regexp_extract("_norm", f"(?s)^(.*) {any_phrase}", 1))).alias("last_word"),
        F.filter(
            F.array(*[F.when(F.contains(F.col("_norm"), F.lit(f" {phrase} ")), F.lit(label)) for label, phrase in PHRASES.items()]),
            lambda x: x.isNotNull(),
        ).alias("_base"),
        F.sha2("_folded", 256).alias("_key"),
        "_folded",
    )
    # all texts are read once; what is written of them holds the text only of those that pass the gate
    row = stored(row, "license-rows")
    texts = row.filter("_key IS NOT NULL").select(F.col("_key").alias("text_key"), F.col("_folded").alias("lower")).dropDuplicates(["text_key"])
    per_text = (
        detect(texts)
        .groupBy("text_key")
        .agg(F.collect_set("label").alias("_labels"), F.count(F.lit(1)).alias("_n"), F.max("weight").alias("_weight"))
    )
    row = row.drop("_folded")
    rest = row.filter("_key IS NULL")
    for f in per_text.schema.fields:
        rest = rest.withColumn(f.name, F.lit(None).cast(f.dataType))
    joined = row.filter("_key IS NOT NULL").join(per_text, F.col("_key") == F.col("text_key"), "left").unionByName(rest)
    labels = F.array_sort(F.array_distinct(F.concat("_base", F.coalesce("_labels", F.array().cast("array<string>")))))
    return joined.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("_base", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.coalesce("_n", F.lit(0)).cast("long").alias("n_detections"),
        F.greatest(F.coalesce("_weight", F.lit(0.0)), F.when(found, 0.9).otherwise(0.0)).alias("score"),
    )
