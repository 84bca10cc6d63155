"""License detection by ordered signature rules, in DataFrame functions only.

A text is reduced to its words, single blanks between them. Only texts with one of a
few hints get that far. Of some two hundred rules only those whose keyword the text
contains are matched. A detection is an interval of words with a priority; one that
lies within another of the same or a better priority is dropped, so that "licensed
under the apache license version 2 0" is one finding and not four.
"""

import json
from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtide.llm.common import column, fresh

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # of a text in lower case
ANY_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # of any text
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# The phrases that always count, and their labels
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# What licenses are called, and their versions. Label, names, versions.
FAMILIES = (
    ("gpl", ("gnu general public license", "gnu gpl", "gpl"), ("1", "2", "3")),
    ("lgpl", ("gnu lesser general public license", "gnu library general public license", "lgpl"), ("2", "2 1", "3")),
    ("agpl", ("gnu affero general public license", "affero general public license", "agpl"), ("1", "3")),
    ("gfdl", ("gnu free documentation license", "gfdl"), ("1 1", "1 2", "1 3")),
    ("apache", ("apache software license", "apache license"), ("1 0", "1 1", "2 0")),
    ("mit", ("mit license", "expat license", "x11 license"), ()),
    ("bsd", ("bsd style license", "bsd license", "berkeley software distribution license"), ()),
    ("bsd-2-clause", ("bsd 2 clause", "2 clause bsd", "simplified bsd license", "freebsd license"), ()),
    ("bsd-3-clause", ("bsd 3 clause", "3 clause bsd", "new bsd license", "modified bsd license"), ()),
    ("isc", ("isc license", "internet software consortium license"), ()),
    ("zlib", ("zlib license", "zlib libpng license"), ()),
    ("mpl", ("mozilla public license", "mpl license"), ("1 0", "1 1", "2 0")),
    ("epl", ("eclipse public license",), ("1 0", "2 0")),
    ("cpl", ("common public license",), ("1 0",)),
    ("cddl", ("common development and distribution license", "cddl license"), ("1 0", "1 1")),
    ("eupl", ("european union public license",), ("1 0", "1 1", "1 2")),
    ("artistic", ("artistic license",), ("1 0", "2 0")),
    ("afl", ("academic free license",), ("2 1", "3 0")),
    ("osl", ("open software license",), ("2 1", "3 0")),
    ("boost", ("boost software license",), ("1 0",)),
    ("ofl", ("sil open font license", "open font license"), ("1 0", "1 1")),
    ("psf", ("python software foundation license",), ("2",)),
    ("php", ("php license",), ("3 0", "3 01")),
    ("ms-pl", ("microsoft public license",), ()),
    ("ms-rl", ("microsoft reciprocal license",), ()),
    ("postgresql", ("postgresql license",), ()),
    ("odbl", ("open database license", "odbl license"), ("1 0",)),
    ("odc-by", ("open data commons attribution license",), ("1 0",)),
    ("pddl", ("public domain dedication and license",), ("1 0",)),
    ("wtfpl", ("do what the fuck you want to public license", "wtfpl"), ("1", "2")),
    ("unlicense", ("unlicense license", "the unlicense"), ()),
    ("cc0", ("creative commons zero", "cc0"), ("1 0",)),
    ("public-domain", ("public domain",), ()),
    ("all-rights-reserved", ("all rights reserved",), ()),
)
# The marks of the attribution licenses, and their names
MARKS = (
    ("", ""),
    (" sa", " share ?alike"),
    (" nc", " non ?commercial"),
    (" nd", " no ?deriv(?:ative)?s"),
    (" nc sa", " non ?commercial share ?alike"),
    (" nc nd", " non ?commercial no ?deriv(?:ative)?s"),
)
VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")
GRANT = (
    "(?:licensed|released|distributed|available|published|provided|covered|issued|shared|offered) "
    "(?:under|by|through) (?:the |an? )?(?:terms (?:and conditions )?of (?:the |an? )?)?"
)
# Words that one of the rules' keywords always contains; others need no look at the text.
HINTS = ("licen[cs]", "gpl", "gfdl", "cc0", "wtfpl", "bsd", "cc{b}by", "creative{b}commons", "public{b}domain", "rights{b}reserved")
DETECTIONS = "array<struct<start:int,stop:int,priority:int,confidence:double,label:string>>"
LEVELS = 5  # priorities: identifier, grant with version, version, grant, name


def rules() -> list[dict]:
    """The rules in their order: keyword, pattern, label, priority (0 first), confidence."""
    families = [(label, [(n, n) for n in names], versions) for label, names, versions in FAMILIES]
    for short, long in MARKS:
        names = [(f"cc by{short}", f"cc by{short}"), ("creative commons", f"creative commons attribution{long}")]
        families.append((f"cc by{short}".replace(" ", "-"), names, VERSIONS))
    found = []

    def add(priority, keyword, pattern, label, confidence):
        found.append(
            {"keyword": f" {keyword}", "pattern": f" (?:{pattern})(?= )", "label": label,
             "priority": priority, "confidence": confidence}
        )

    for label, names, versions in families:
        words = label.replace("-", " ")
        add(0, "spdx license", f"spdx license identifier {words}", label, 1.0)
        for version in versions:
            full = f"{label}-{version.replace(' ', '.')}" + ("" if " " in version else ".0")
            number = version if " " in version else f"{version}(?: 0)?"
            add(0, "spdx license", f"spdx license identifier {words} {number}(?: only| or later)?", full, 1.0)
        for keyword, name in names:
            called = f"{name}(?: license| licence| public license)?"
            add(3, keyword, GRANT + called, label, 0.85)
            add(4, keyword, name, label, 0.6)
        for (keyword, name), version in product(names, versions):
            full = f"{label}-{version.replace(' ', '.')}" + ("" if " " in version else ".0")
            number = f"(?:version |ver |v )?v?{version}" + ("" if " " in version else "(?: 0)?")
            called = f"{name}(?: license| licence| public license)? {number}(?: only| or later| or any later version)?"
            add(1, keyword, GRANT + called, full, 0.99)
            add(2, keyword, called, full, 0.9)
    return found


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _detections(norm: Column, rule: Column) -> Column:
    """The intervals of words that one rule matches. Every word has one blank before it."""
    matches = F.regexp_extract_all(norm, rule["pattern"], F.lit(0))
    before = F.slice(F.split(norm, rule["pattern"], -1), F.lit(1), F.size(matches))

    def add(state, step):
        start = state["at"] + _spaces(step["before"])
        stop = start + _spaces(step["match"])
        one = F.struct(
            start.alias("start"), stop.alias("stop"), rule["priority"].alias("priority"),
            rule["confidence"].alias("confidence"), rule["label"].alias("label"),
        )
        return F.struct(stop.alias("at"), F.concat(state["found"], F.array(one)).alias("found"))

    steps = F.arrays_zip(before.alias("before"), matches.alias("match"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(DETECTIONS).alias("found"))
    return F.aggregate(steps, start, add, lambda state: state["found"])


def _resolved(found: Column) -> Column:
    """Without detections that lie within one of the same or a better priority.

    In the order of their starts, longest first, all that may contain a detection
    comes before it; the farthest end so far of each priority is enough to know.
    """
    by_place = lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(
        F.when(a["stop"] != b["stop"], b["stop"] - a["stop"]).otherwise(a["priority"] - b["priority"])
    )
    ordered = F.array_sort(found, by_place)

    def add(state, one):
        ends = F.slice(state["ends"], F.lit(1), one["priority"] + 1)
        kept = F.when(F.array_max(ends) >= one["stop"], state["kept"]).otherwise(
            F.concat(state["kept"], F.array(one))
        )
        farther = F.transform(
            state["ends"], lambda end, i: F.when(i == one["priority"], F.greatest(end, one["stop"])).otherwise(end)
        )
        return F.struct(farther.alias("ends"), kept.alias("kept"))

    start = F.struct(
        F.array_repeat(F.lit(-1), LEVELS).alias("ends"), F.array().cast(DETECTIONS).alias("kept")
    )
    return F.aggregate(ordered, start, add, lambda state: state["kept"])


def _places(words: Column, phrase: str) -> Column:
    """All words at which a phrase starts."""
    parts = phrase.split()
    last = F.size(words) - len(parts)
    same = lambda i: F.forall(
        F.array(*[F.struct(F.lit(k).alias("k"), F.lit(p).alias("p")) for k, p in enumerate(parts)]),
        lambda x: F.get(words, i + x["k"]) == x["p"],
    )
    return F.when(last >= 0, F.filter(F.sequence(F.lit(0), last), same)).otherwise(F.array().cast("array<int>"))


def scan(
    docs: DataFrame,
    text_col: str = "text",
    phrases: Sequence[tuple[str, str]] = PHRASES,
    out: str = "licenses",
) -> DataFrame:
    """``docs`` with one more column, a struct of what was found in the whole text.

    ``n_words``; ``base``: the places of each phrase, in order; ``found``: the resolved
    detections with start, stop (in words), priority, confidence and label. A null or
    empty text has no words and no findings. Phrases that overlap all count.
    """
    names = {n: fresh(docs, n) for n in ("hinted", "words", "norm")}
    text = column(text_col)
    extra = [BETWEEN.join(_escaped(w) for w in phrase.split()) for phrase, _ in phrases]
    hints = "(?i)" + "|".join([*(h.replace("{b}", BETWEEN) for h in HINTS), *extra])
    table = F.from_json(
        F.lit(json.dumps(rules())),
        "array<struct<keyword:string,pattern:string,label:string,priority:int,confidence:double>>",
    )
    words, norm, hinted = (column(names[n]) for n in ("words", "norm", "hinted"))
    small = F.translate(text, LETTERS, LETTERS.lower())
    rows = docs.withColumn(names["hinted"], F.coalesce(text.rlike(hints), F.lit(False)))
    rows = rows.withColumn(names["words"], F.when(hinted, F.regexp_extract_all(small, F.lit(WORD), F.lit(0))))
    rows = rows.withColumn(names["norm"], F.when(hinted, F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))))
    base = F.array(
        *[
            F.when(F.contains(norm, F.lit(f" {phrase} ")), _places(words, phrase)).otherwise(
                F.array().cast("array<int>")
            )
            for phrase, _ in phrases
        ]
    )
    fit = F.filter(table, lambda rule: F.contains(norm, rule["keyword"]))
    found = _resolved(F.flatten(F.transform(fit, lambda rule: _detections(norm, rule))))
    result = F.struct(
        F.coalesce(F.when(hinted, F.size(words)).otherwise(F.regexp_count(text, F.lit(ANY_WORD))), F.lit(0))
        .cast("long")
        .alias("n_words"),
        F.when(hinted, base).otherwise(F.array().cast("array<array<int>>")).alias("base"),
        F.when(hinted, found).otherwise(F.array().cast(DETECTIONS)).alias("found"),
    )
    return rows.withColumn(out, result).select(*[column(c) for c in docs.columns], column(out))


def _escaped(word: str) -> str:
    return "".join(c if c.isalnum() else f"\\{c}" for c in word)


def digest(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: Sequence[tuple[str, str]] = PHRASES,
) -> DataFrame:
    """``id_col, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    One row for every row of ``docs``. Labels are distinct, sorted and joined by
    commas, empty if there are none; the score is the greatest confidence found.
    """
    out = fresh(docs, "licenses")
    it = column(out)
    rows = scan(docs, text_col, phrases, out)
    starts = F.flatten(it["base"])
    hit = F.filter(
        F.transform(it["base"], lambda places, i: F.when(F.size(places) > 0, F.get(F.array(*[F.lit(x) for _, x in phrases]), i))),
        lambda label: label.isNotNull(),
    )
    own = F.transform(it["found"], lambda one: one["label"])
    best = F.array_max(F.transform(it["found"], lambda one: one["confidence"]))
    return rows.select(
        column(id_col),
        it["n_words"].alias("n_words"),
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(hit)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(hit, own)), ",").alias("labels"),
        F.coalesce(best, F.when(F.size(starts) > 0, 0.5), F.lit(0.0)).alias("score"),
    )
