"""License notices by ordered signature rules.

Rules work on the words of a text in lower case with one space between them, so
punctuation and line breaks do not matter. Each license family has hand-written
patterns for its name; forms around the name (a tag, a grant, an address, the bare
name) make the rules. A rule is tried only where its keyword occurs. Detections are
intervals of words: one that lies inside another of the same or a higher priority is
suppressed; of equal intervals the rule that comes first stays.

All of it is done inside a row with built-in functions: nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codecorpus.llm.common import NOT_WORD, ascii_lower

#: Phrases and labels of the base.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

V = r"(?: (?:version|v))?"
LIC = r"(?: (?:public )?licen[cs]e)"
ONLY = r"(?: only| or(?: \(?at your option\)?)? any later version| or later)?"

#: label, keyword, pattern of the name. Specific before general. Every text that a pattern matches holds the keyword at
#: the start of a word; an alternative without it is a family of its own.
FAMILIES = [
    ("agpl-3.0", "affero", rf"(?:gnu )?affero general public licen[cs]e{V} v?3(?: 0)?{ONLY}"),
    ("agpl-3.0", "agpl", rf"(?:gnu )?agpl{V} ?v?3(?: 0)?{ONLY}"),
    ("agpl", "affero", r"(?:gnu )?affero general public licen[cs]e"),
    ("agpl", "agpl", rf"agpl{LIC}?"),
    ("lgpl-3.0", "lesser", rf"(?:gnu )?lesser general public licen[cs]e{V} v?3(?: 0)?{ONLY}"),
    ("lgpl-2.1", "lesser", rf"(?:gnu )?lesser general public licen[cs]e{V} v?2 1{ONLY}"),
    ("lgpl-2.0", "library", rf"(?:gnu )?library general public licen[cs]e{V} v?2(?: 0)?{ONLY}"),
    ("lgpl-3.0", "lgpl", rf"lgpl{V} ?v?3(?: 0)?{ONLY}"),
    ("lgpl-2.1", "lgpl", rf"lgpl{V} ?v?2 1{ONLY}"),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public licen[cs]e"),
    ("lgpl", "lgpl", rf"lgpl{LIC}?"),
    ("gpl-3.0", "general", rf"(?:gnu )?general public licen[cs]e{V} v?3(?: 0)?{ONLY}"),
    ("gpl-2.0", "general", rf"(?:gnu )?general public licen[cs]e{V} v?2(?: 0)?{ONLY}"),
    ("gpl-1.0", "general", rf"(?:gnu )?general public licen[cs]e{V} v?1(?: 0)?{ONLY}"),
    ("gpl-3.0", "gpl", rf"(?:gnu )?gpl{V} ?v?3(?: 0)?{ONLY}"),
    ("gpl-3.0", "gplv3", r"(?:gnu )?gplv3(?: 0)?"),
    ("gpl-2.0", "gpl", rf"(?:gnu )?gpl{V} ?v?2(?: 0)?{ONLY}"),
    ("gpl-2.0", "gplv2", r"(?:gnu )?gplv2(?: 0)?"),
    ("gpl", "general", r"gnu general public licen[cs]e"),
    ("gpl", "gpl", rf"(?:gnu )?gpl{LIC}?"),
    ("gfdl-1.3", "documentation", rf"gnu free documentation licen[cs]e{V} 1 3"),
    ("gfdl", "documentation", r"gnu free documentation licen[cs]e"),
    ("apache-2.0", "apache", rf"apache(?: software)?(?: licen[cs]e)?{V} v?2(?: 0)?"),
    ("apache-1.1", "apache", rf"apache(?: software)?(?: licen[cs]e)?{V} v?1 1"),
    ("apache", "apache", r"apache(?: software)? licen[cs]e"),
    ("cc0-1.0", "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("cc-by-nc-nd-4.0", "cc", r"cc by nc nd 4 0"),
    ("cc-by-nc-sa-4.0", "cc", r"cc by nc sa 4 0"),
    ("cc-by-nc-4.0", "cc", r"cc by nc 4 0"),
    ("cc-by-nd-4.0", "cc", r"cc by nd 4 0"),
    ("cc-by-sa-4.0", "cc", r"cc by sa 4 0"),
    ("cc-by-sa-3.0", "cc", r"cc by sa 3 0"),
    ("cc-by-4.0", "cc", r"cc by 4 0"),
    ("cc-by-3.0", "cc", r"cc by 3 0"),
    ("cc-by-nc-nd", "cc", r"cc by nc nd"),
    ("cc-by-nc-sa", "cc", r"cc by nc sa"),
    ("cc-by-nc", "cc", r"cc by nc"),
    ("cc-by-nd", "cc", r"cc by nd"),
    ("cc-by-sa", "cc", r"cc by sa"),
    ("cc-by-nc", "commons", r"creative commons attribution non ?commercial(?: \d \d)?(?: international| unported)?"),
    ("cc-by-sa", "commons", r"creative commons attribution share ?alike(?: \d \d)?(?: international| unported)?"),
    ("cc-by-nd", "commons", r"creative commons attribution no ?deriv(?:ative)?s(?: \d \d)?(?: international| unported)?"),
    ("cc-by", "commons", r"creative commons attribution(?: \d \d)?(?: international| unported)?"),
    ("cc", "commons", r"creative commons"),
    ("mit", "mit", rf"mit(?: x11)?{LIC}"),
    ("mit", "expat", rf"expat{LIC}"),
    ("x11", "x11", rf"x11{LIC}"),
    ("bsd-2-clause", "bsd", r"(?:simplified bsd|bsd 2 clause|2 clause bsd|two clause bsd)(?: licen[cs]e)?"),
    ("bsd-2-clause", "freebsd", r"freebsd(?: licen[cs]e)?"),
    ("bsd-3-clause", "bsd", r"(?:(?:new|modified|revised) bsd|bsd 3 clause|3 clause bsd|three clause bsd)(?: licen[cs]e)?"),
    ("bsd-4-clause", "bsd", r"(?:original bsd|bsd 4 clause|4 clause bsd)(?: licen[cs]e)?"),
    ("0bsd", "0bsd", r"0bsd"),
    ("0bsd", "zero clause", r"zero clause bsd"),
    ("bsd", "bsd", rf"bsd(?: style)?{LIC}"),
    ("mpl-2.0", "mozilla", rf"mozilla public licen[cs]e{V} v?2(?: 0)?"),
    ("mpl-1.1", "mozilla", rf"mozilla public licen[cs]e{V} v?1 1"),
    ("mpl-2.0", "mpl", rf"mpl{V} ?v?2(?: 0)?"),
    ("mpl", "mozilla", r"mozilla public licen[cs]e"),
    ("epl-2.0", "eclipse", rf"eclipse public licen[cs]e{V} v?2(?: 0)?"),
    ("epl-1.0", "eclipse", rf"eclipse public licen[cs]e{V} v?1(?: 0)?"),
    ("epl", "eclipse", r"eclipse public licen[cs]e"),
    ("cddl-1.0", "cddl", r"cddl(?: v?1(?: 0)?)?"),
    ("cddl-1.0", "distribution", r"common development and distribution licen[cs]e"),
    ("cpl-1.0", "common", r"common public licen[cs]e"),
    ("eupl-1.2", "european", r"european union public licen[cs]e"),
    ("isc", "isc", rf"isc{LIC}"),
    ("zlib", "zlib", rf"zlib(?: libpng)?{LIC}"),
    ("bsl-1.0", "boost", r"boost software licen[cs]e"),
    ("unlicense", "unlicense", r"(?:the )?unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("artistic-2.0", "artistic", r"artistic licen[cs]e(?: version)? 2(?: 0)?"),
    ("artistic", "artistic", r"artistic licen[cs]e"),
    ("python", "python", r"python software foundation licen[cs]e"),
    ("python", "psf", r"psf licen[cs]e"),
    ("php", "php", r"php licen[cs]e"),
    ("ruby", "ruby", r"ruby licen[cs]e"),
    ("ofl-1.1", "font", r"(?:sil )?open font licen[cs]e(?: version)?(?: 1 1)?"),
    ("odbl-1.0", "database", r"open database licen[cs]e"),
    ("pddl-1.0", "dedication", r"public domain dedication and licen[cs]e"),
    ("public-domain", "domain", r"(?:in|into|to) the public domain"),
    ("ms-pl", "microsoft", r"microsoft public licen[cs]e"),
    ("ncsa", "illinois", r"university of illinois(?: ncsa)? open source licen[cs]e"),
    ("postgresql", "postgresql", r"postgresql licen[cs]e"),
    ("openssl", "openssl", r"openssl licen[cs]e"),
    ("proprietary", "reserved", r"all rights reserved"),
]
#: priority, confidence, and what stands around the name (``{}``).
FORMS = [
    (3, 1.0, "spdx license identifier {}"),
    (2, 0.95, r"(?:licensed|released|distributed|published|available|provided|covered|governed|redistribute it) (?:\w+ ){{0,3}}?under (?:the )?(?:terms of )?(?:the )?(?:{})"),
    (2, 0.8, r"(?:licen[cs]e|license text|licensing)(?: is| type)? (?:the )?(?:{})"),
    (1, 0.6, "(?:{})"),
]


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    pattern: str
    priority: int
    confidence: float


def rules() -> list[Rule]:
    """All rules, higher priorities first, then in the order of the families; each pattern once."""
    found: dict[tuple[str, str], Rule] = {}
    for priority, confidence, form in FORMS:
        for label, keyword, name in FAMILIES:
            tag = label.replace(".", " ").replace("-", " ") + ONLY
            inner = form.format(tag if priority == 3 else name)
            rule = Rule(label, "spdx" if priority == 3 else keyword, rf"(?<![^ ])(?:{inner})(?![^ ])", priority, confidence)
            found.setdefault((label, rule.pattern), rule)
    return list(found.values())


def spaced(text: Column) -> Column:
    return F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD, " "))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _prefix(n: int):
    return lambda w: F.substring(w, 1, n)


def present_gates(clean: Column, known: list[Rule]) -> Column:
    """The rules' gate words (first word of a keyword) that begin some word of the spaced text, found in one pass.

    Every text that a rule matches holds its keyword at the start of a word, so a rule whose
    gate is absent cannot match; glued forms such as ``gplv3`` begin with their gate too.
    """
    gates = sorted({x.keyword.split(" ")[0] for x in known})
    words = F.split(clean, " ")
    prefixes = F.flatten(F.array(*(F.transform(words, _prefix(n)) for n in sorted({len(g) for g in gates}))))
    return F.array_intersect(prefixes, F.array(*map(F.lit, gates)))


def detections(clean: Column, known: list[Rule], gates: Column) -> Column:
    """All detections of the rules in a spaced text, ordered by start, longest first, higher priority first.

    ``gates``: ``present_gates`` of the text, a column of its own (Spark would compute an expression
    inside the rule loop once per rule). Only rules whose gate word is present are tried, so a text
    meets the regexes of its own keywords alone.
    """
    table = F.array(*(
        F.struct(F.lit(x.keyword.split(" ")[0]).alias("gate"), F.lit(x.pattern).alias("pattern"), F.lit(x.label).alias("label"),
                 F.lit(x.priority).alias("priority"), F.lit(x.confidence).alias("confidence"), F.lit(k).alias("rule"))
        for k, x in enumerate(known)))

    def spans(rule: Column) -> Column:
        marked = F.split(F.regexp_replace(clean, rule.pattern, F.lit("\u0001$0\u0002")), " ")
        at = lambda test: F.filter(F.transform(marked, lambda w, i: F.when(test(w), i)), lambda i: i.isNotNull())
        starts, ends = at(lambda w: w.startswith("\u0001")), at(lambda w: w.endswith("\u0002"))
        return F.zip_with(starts, ends, lambda s, e: F.struct(
            s.alias("start"), (-e).alias("minus_end"), (-rule.priority).alias("minus_priority"), rule.rule.alias("rule"),
            rule.label.alias("label"), rule.confidence.alias("confidence")))

    tried = F.filter(table, lambda r: F.array_contains(gates, r.gate) & F.regexp_like(clean, r.pattern))
    return F.sort_array(F.flatten(F.transform(tried, spans)))


def surviving(found: Column) -> Column:
    """``labels`` and ``score`` (greatest confidence) of the detections that no other suppresses."""
    start = F.struct(
        F.lit(-1).alias("end1"), F.lit(-1).alias("end2"), F.lit(-1).alias("end3"),
        F.array().cast("array<string>").alias("labels"), F.lit(0.0).alias("score"))

    def step(seen: Column, x: Column) -> Column:
        end, level = -x.minus_end, -x.minus_priority
        covered = F.when(level == 1, seen.end1).when(level == 2, seen.end2).otherwise(seen.end3) >= end
        reach = lambda k, old: F.when(level >= k, F.greatest(old, end)).otherwise(old)
        return F.struct(
            reach(1, seen.end1).alias("end1"), reach(2, seen.end2).alias("end2"), reach(3, seen.end3).alias("end3"),
            F.when(covered, seen.labels).otherwise(F.array_union(seen.labels, F.array(x.label))).alias("labels"),
            F.when(covered, seen.score).otherwise(F.greatest(seen.score, x.confidence)).alias("score"))

    return F.aggregate(found, start, step)


def keyword_filter(clean: Column, known: list[Rule]) -> Column:
    words = sorted({x.keyword for x in known})
    return clean.rlike(f"(?<![^ ])(?:{'|'.join(words)})")


def license_spans(docs: DataFrame, known: list[Rule] | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows ``doc_id, text_hash, start_word, end_word, label, priority, confidence`` of the detections that stay (words from 0)."""
    known = known or rules()
    key = [F.col(id_column).alias("doc_id"), F.xxhash64(text_column).alias("text_hash")]
    clean = docs.select(*key, spaced(F.col(text_column)).alias("clean")).filter(keyword_filter(F.col("clean"), known))
    clean = clean.withColumn("gates", present_gates(F.col("clean"), known))
    found = detections(F.col("clean"), known, F.col("gates"))
    rows = clean.select("doc_id", "text_hash", F.explode(found).alias("x")).select("doc_id", "text_hash", "x.*").distinct()
    before = Window.partitionBy("doc_id", "text_hash").orderBy("start", "minus_end", "minus_priority", "rule").rowsBetween(Window.unboundedPreceding, -1)
    reach = {k: F.max(F.when(F.col("minus_priority") <= -k, -F.col("minus_end"))).over(before) for k in (1, 2, 3)}
    covered = F.coalesce(F.when(F.col("minus_priority") == -1, reach[1]).when(F.col("minus_priority") == -2, reach[2]).otherwise(reach[3]), F.lit(-1))
    kept = rows.withColumn("covered", covered >= -F.col("minus_end")).filter("not covered")
    return kept.select("doc_id", "text_hash", F.col("start").alias("start_word"), (-F.col("minus_end")).alias("end_word"), "label",
                       (-F.col("minus_priority")).alias("priority"), "confidence")


def scan_licenses(docs: DataFrame, known: list[Rule] | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``, one for each row of ``docs``.

    A null text is empty: no words, no labels (empty strings), null places, score 0. A base phrase alone scores 0.5.
    """
    known = known or rules()
    clean = docs.select(F.col(id_column).alias("doc_id"), spaced(F.col(text_column)).alias("clean"))
    clean = clean.withColumn("gates", F.when(keyword_filter(F.col("clean"), known), present_gates(F.col("clean"), known)))
    n_words = F.when(F.col("clean") == "", 0).otherwise(_spaces(F.col("clean")) + 1).cast("bigint")
    has_base = F.col("clean").rlike(f"(?<![^ ])(?:{'|'.join(BASE)})(?![^ ])")
    # each word between two spaces of its own, so that phrases do not share one
    wide = F.when(has_base, F.concat(F.lit(" "), F.replace("clean", F.lit(" "), F.lit("  ")), F.lit(" ")))
    rows = clean.select(
        "doc_id", n_words.alias("n_words"), wide.alias("wide"),
        F.when(F.col("gates").isNotNull(), surviving(detections(F.col("clean"), known, F.col("gates")))).alias("own"))
    counts, firsts, lasts, names = [], [], [], []
    for phrase, label in BASE.items():
        mark = f" {phrase.replace(' ', '  ')} "
        at = F.instr("wide", mark)
        back = F.instr(F.reverse("wide"), mark[::-1])
        counts.append(F.floor((F.length("wide") - F.length(F.replace("wide", F.lit(mark), F.lit("")))) / len(mark)))
        firsts.append(F.when(at > 0, F.floor(_spaces(F.substring("wide", F.lit(1), at - 1)) / 2)))
        after = F.floor(_spaces(F.substring(F.reverse("wide"), F.lit(1), back - 1)) / 2)
        lasts.append(F.when(back > 0, F.col("n_words") - after - len(phrase.split())))
        names.append(F.when(at > 0, F.lit(label)))
    base = F.sort_array(F.array_compact(F.array(*names)))
    own = F.coalesce("own.labels", F.array().cast("array<string>"))
    n_base = F.coalesce(sum(counts[1:], counts[0]), F.lit(0)).cast("bigint")
    return rows.select(
        "doc_id", "n_words", n_base.alias("n_base"), F.least(*firsts).cast("bigint").alias("first_word"),
        F.greatest(*lasts).cast("bigint").alias("last_word"), F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union(base, own)), ",").alias("labels"),
        F.greatest(F.coalesce("own.score", F.lit(0.0)), F.when(n_base > 0, 0.5).otherwise(0.0)).alias("score"))
