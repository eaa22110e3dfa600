"""License detection by ordered signature rules.

Signatures are regular expressions over a text's words (lower-cased, joined by single
spaces), each with a label, a priority and a keyword: a word that any match contains.
Every match also contains one of a few cues, which are looked for in the raw text: only
texts with a cue are taken apart into words, and each is searched only for the
signatures whose keyword is among its words. Of
overlapping detections, one that lies within another of at least its priority is
suppressed: a full notice hides the name inside it, a longer name a shorter one.

Signatures are written by hand for each license: its names and ids, the sentences of
its text or notice. The forms that every name takes ("licensed under the ...", "... license
version ...") come from a rule, which makes some hundreds of them.

Everything is DataFrame code: the cue test reads every whole text once; positions
come from marks put around matches, so they are found in one pass over a text's words.

Defined results: null and empty texts have no words and no labels; equal detections
count once (the lesser label); repeated rows are judged alike; a null doc_id is kept; an
empty table gives an empty result; other columns are dropped.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import written

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word: digits, Latin letters and everything beyond ASCII.
WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"

#: Phrases whose places are always counted, and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Priorities: a whole notice or grant, an id, a name in a sentence that applies it, a bare name.
NOTICE, ID, APPLIED, NAME = 40, 30, 20, 10
#: How sure a detection of each priority makes one.
CONFIDENCE = {NOTICE: 1.0, ID: 0.95, APPLIED: 0.9, NAME: 0.6}

#: label -> (names as patterns, ids as patterns). Names and ids are fixed values.
LICENSES = {
    "mit": (["mit", "mit x11", "mit expat"], ["mit", "mit 0"]),
    "apache": (["apache", "apache software", "apache 2(?: 0)?", "asl 2 0"], ["apache 1 1", "apache 2 0"]),
    "gpl": (["gnu gpl", "gpl", "gplv2", "gplv3", "gpl v?[23]"], ["gpl [123] 0(?: only| or later)?"]),
    "gpl-full": (["gnu general public", "general public"], []),
    "lgpl": (["gnu lgpl", "lgpl", "lgplv2", "lgplv3"], ["lgpl [23] [01](?: only| or later)?"]),
    "lgpl-full": (["gnu lesser general public", "lesser general public"], []),
    "agpl": (["gnu agpl", "agpl", "agplv3"], ["agpl [13] 0(?: only| or later)?"]),
    "agpl-full": (["gnu affero general public", "affero general public"], []),
    "gfdl": (["gnu free documentation", "free documentation"], ["gfdl 1 [123]"]),
    "bsd": (["bsd", "new bsd", "modified bsd", "simplified bsd", "freebsd", "[234] clause bsd", "bsd [0234] clause"], ["bsd [1234] clause", "0bsd"]),
    "isc": (["isc", "internet systems consortium"], ["isc"]),
    "mpl": (["mozilla public"], ["mpl [12] [01]"]),
    "epl": (["eclipse public"], ["epl [12] 0"]),
    "edl": (["eclipse distribution"], []),
    "cddl": (["common development and distribution"], ["cddl 1 [01]"]),
    "cpl": (["common public"], ["cpl 1 0"]),
    "eupl": (["european union public"], ["eupl 1 [012]"]),
    "artistic": (["artistic", "perl artistic", "clarified artistic"], ["artistic [12] 0"]),
    "zlib": (["zlib", "zlib libpng"], ["zlib"]),
    "libpng": (["libpng", "png reference library"], ["libpng 2 0"]),
    "boost": (["boost software"], ["bsl 1 0"]),
    "wtfpl": (["wtfpl", "do what the fuck you want to public"], ["wtfpl"]),
    "unlicense": (["unlicense", "the unlicense"], ["unlicense"]),
    "cc0": (["cc0", "cc0 1 0 universal", "creative commons zero"], ["cc0 1 0"]),
    "cc-by": (["creative commons attribution", "cc by"], ["cc by [1234] [05]"]),
    "cc-by-sa": (["creative commons attribution share ?alike", "cc by sa"], ["cc by sa [1234] [05]"]),
    "cc-by-nc": (["creative commons attribution non ?commercial", "cc by nc"], ["cc by nc [1234] [05]"]),
    "cc-by-nd": (["creative commons attribution no ?deriv(?:atives|s)", "cc by nd"], ["cc by nd [1234] [05]"]),
    "cc-by-nc-sa": (["creative commons attribution non ?commercial share ?alike", "cc by nc sa"], ["cc by nc sa [1234] [05]"]),
    "python": (["python software foundation", "python", "psf"], ["psf 2 0", "python 2 0"]),
    "php": (["php"], ["php 3 0[1]?"]),
    "ruby": (["ruby"], ["ruby"]),
    "openssl": (["openssl", "ssleay"], ["openssl"]),
    "postgresql": (["postgresql"], ["postgresql"]),
    "ofl": (["sil open font"], ["ofl 1 [01]"]),
    "odbl": (["open database", "odc open database"], ["odbl 1 0"]),
    "ms-pl": (["microsoft public"], ["ms pl"]),
    "ms-rl": (["microsoft reciprocal"], ["ms rl"]),
    "upl": (["universal permissive"], ["upl 1 0"]),
    "ncsa": (["university of illinois ncsa open source", "ncsa open source"], ["ncsa"]),
    "afl": (["academic free"], ["afl [123] [012]"]),
    "osl": (["open software"], ["osl [123] [01]"]),
    "bsl": (["business source"], ["busl 1 1"]),
    "sspl": (["server side public"], ["sspl 1 0"]),
    "vim": (["vim"], ["vim"]),
    "curl": (["curl"], ["curl"]),
    "x11": (["x11", "x consortium"], ["x11"]),
    "beerware": (["beerware", "beer ware"], ["beerware"]),
    "public-domain": (["public domain"], []),
    "proprietary": (["proprietary"], []),
}
#: Labels that name the same license in full.
_SAME = {"gpl-full": "gpl", "lgpl-full": "lgpl", "agpl-full": "agpl"}

#: (label, pattern): sentences of license texts and notices (fixed values).
NOTICES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "redistributions of source code must retain the above copyright notice"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd", "neither the names? of .{1,80}? may be used to endorse or promote products"),
    ("apache", "you may not use this file except in compliance with the license"),
    ("apache", "http www apache org licenses(?: license 2 0)?"),
    ("apache", "licensed to the apache software foundation"),
    ("gpl", "redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "you should have received a copy of the gnu general public license"),
    ("gpl", "either version [23] of the license or at your option any later version"),
    ("lgpl", "redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("lgpl", "you should have received a copy of the gnu (?:lesser|library) general public license"),
    ("agpl", "under the terms of the gnu affero general public license"),
    ("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("mpl", "http mozilla org mpl 2 0"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("cddl", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("boost", "distributed under the boost software license"),
    ("cc0", "dedicated all copyright and related and neighboring rights to this software to the public domain"),
    ("cc-by", "this work is licensed under a creative commons attribution [0-9] 0"),
    ("ofl", "this font software is licensed under the sil open font license"),
    ("public-domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("proprietary", "all rights reserved"),
    ("copyright", "copyright c(?: [0-9]{4})+"),
    ("copyright", "copyright [0-9]{4}"),
)


#: Parts of words, one of which is in any match; the verbs of grants are among them.
CUES = ("licen", "spdx", "copyright", "permission", "redistribution", "endorse", "warranty", "unencumbered", "dedicated", "reserved",
        "released", "distributed", "available", "published", "covered", "provided", "mozilla", "commons", "domain", "proprietary", "gnu")
_GRANT = "(?:licensed|released|distributed|available|published|covered|provided) (?:under|by) (?:the |an? )?(?:terms of )?(?:the )?"


def _keyword(name: str) -> str:
    """The longest word that stands whole in a pattern of words."""
    return max((w for w in re.sub(r"\(.*?\)\S*|\S*[\[?].*?(?= |$)", " ", name).split() if w.isalnum()), key=len)


def signatures() -> list[tuple[str, str, int, str]]:
    """(label, keyword, priority, pattern) in order of priority; patterns match whole words."""
    out = [(label, _keyword(pattern), NOTICE, pattern) for label, pattern in NOTICES]
    for entry, (names, ids) in LICENSES.items():
        label = _SAME.get(entry, entry)
        out += [(label, "spdx", ID, f"spdx license identifier {i}") for i in ids]
        for n in names:
            key = _keyword(n)
            out += [
                (label, key, APPLIED, f"{_GRANT}{n}(?: licen[cs]e)?"),
                (label, key, APPLIED, f"(?:under the terms of|subject to) the {n} licen[cs]e"),
                (label, key, APPLIED, f"{n} licen[cs]e (?:version |v)?[0-9]+(?: [0-9]+)?"),
                (label, key, NAME, f"{n} licen[cs]es?"),
            ]
            if any(c in n for c in ("gnu", "mozilla", "commons", "domain", "proprietary")):
                out.append((label, key, NAME, n))
    return sorted(out, key=lambda s: (-s[2], s[0], s[3]))


def signature_table(spark: SparkSession, rules=None) -> DataFrame:
    """Signatures as rows; their number is fixed by the program."""
    rows = [(label, keyword, priority, rf"(?<= )(?:{pattern})(?= )") for label, keyword, priority, pattern in (signatures() if rules is None else rules)]
    return spark.createDataFrame(rows, "label string, keyword string, priority int, pattern string")


def _spans(words, pattern):
    """Places (first word, last word) of the matches of ``pattern`` in words joined by spaces."""
    marked = F.split(F.regexp_replace(words, pattern, "\x01$0\x02"), " ")
    starts = F.filter(F.transform(marked, lambda w, i: F.when(w.startswith("\x01"), i - 1)), lambda i: i.isNotNull())
    ends = F.filter(F.transform(marked, lambda w, i: F.when(w.endswith("\x02"), i - 1)), lambda i: i.isNotNull())
    return F.zip_with(starts, ends, lambda a, b: F.struct(a.cast("long").alias("first"), b.cast("long").alias("last")))


def gated(docs: DataFrame, cues) -> DataFrame:
    """(place, doc_id, n_words, words): words only of texts that hold a cue, written once.

    ``words`` are lower-cased and stand between single spaces, one at either end too.
    """
    own = docs.select("doc_id", "text", F.lower("text").alias("low"))
    cue = F.lit(False)
    for c in cues:
        cue = cue | F.contains(F.col("low"), F.lit(c))
    joined = F.translate(F.array_join(F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0)), " "), _UPPER, _LOWER)
    words = F.when(cue, F.concat(F.lit(" "), joined, F.lit(" ")))
    count = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    rows = own.select("doc_id", count.alias("n_words"), words.alias("words")).withColumn("place", F.monotonically_increasing_id())
    return written(rows, "license-words")


def detections(rows: DataFrame, rules: DataFrame, keywords: list[str]) -> DataFrame:
    """(place, label, priority, first, last) of all matches that aren't suppressed."""
    found = rows.where("words IS NOT NULL").select("place", "words", F.array_intersect(F.split(F.trim("words"), " "), F.array(*map(F.lit, keywords))).alias("keys"))
    met = found.select("place", "words", F.explode("keys").alias("keyword")).join(F.broadcast(rules), "keyword")
    spans = met.select("place", "label", "priority", F.explode(_spans(F.col("words"), F.col("pattern"))).alias("span")).select("place", "label", "priority", "span.*")
    order = [F.col("first"), F.col("last").desc(), F.col("priority").desc(), F.col("label")]
    earlier = Window.partitionBy("place").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    hidden = F.lit(False)
    for level in CONFIDENCE:
        reach = F.max(F.when(F.col("priority") >= level, F.col("last"))).over(earlier)
        hidden = hidden | ((F.col("priority") == level) & F.coalesce(reach >= F.col("last"), F.lit(False)))
    return spans.withColumn("hidden", hidden).where("NOT hidden").drop("hidden")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules=None) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) per row."""
    spark = docs.sparkSession
    # A caller's signatures are found behind their own keywords, beside which base phrases have their cue.
    cues = CUES if rules is None else sorted({keyword.lower() for _, keyword, *_ in rules} | {"licen"})
    rules = signature_table(spark, rules)
    keywords = sorted(r["keyword"] for r in rules.select("keyword").distinct().collect())
    rows = gated(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), cues)
    sure = F.create_map(*(F.lit(x) for pair in CONFIDENCE.items() for x in pair))
    own = detections(rows, rules, keywords).groupBy("place").agg(F.collect_set("label").alias("own"), F.max(sure[F.col("priority")]).alias("sure"))
    phrases = rows.where("words IS NOT NULL")
    spans = {label: _spans(F.col("words"), F.lit(f"(?<= )(?:{phrase})(?= )")) for phrase, label in BASE.items()}
    phrases = phrases.select("place", *(s["first"].alias(label) for label, s in spans.items()))
    every = F.concat(*(F.col(label) for label in spans))
    named = F.filter(F.array(*(F.when(F.size(label) > 0, F.lit(label)) for label in spans)), lambda x: x.isNotNull())
    base = phrases.select("place", F.size(every).cast("long").alias("n_base"), F.array_min(every).alias("first_word"), F.array_max(every).alias("last_word"), named.alias("base"))
    none = F.array().cast("array<string>")
    out = rows.select("place", "doc_id", "n_words").join(base, "place", "left").join(own, "place", "left")
    both = F.array_union(F.coalesce("base", none), F.coalesce("own", none))
    return out.select(
        F.col("doc_id").alias(doc_id), "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
        F.array_join(F.array_sort(F.coalesce("base", none)), ",").alias("base_labels"), F.array_join(F.array_sort(both), ",").alias("labels"),
        F.greatest(F.coalesce("sure", F.lit(0.0)), F.when(F.col("n_base") > 0, F.lit(CONFIDENCE[NAME])).otherwise(F.lit(0.0))).alias("score"),
    )
