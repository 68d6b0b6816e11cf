"""Licence scans: ordered signature rules behind a keyword prefilter, overlaps resolved by priority and containment.

A text is read as its words (runs of letters, digits and non-ASCII characters), lower-cased and joined by single
spaces, so that one signature covers every punctuation and line break. Only rules whose keyword occurs are
tried; most texts hold no keyword and cost a handful of substring searches. A match that lies inside that of a
rule of the same or a better priority is suppressed. DataFrame functions only.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayfare.llm.common import lower_ascii, stage, table

#: What separates words: every ASCII character but digits and letters. Fixed value.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Phrases that always count, with their labels. Fixed values.
BASE = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]
FULL, NAMED, HINT = 1, 2, 3  # priorities: whole notices and tags, names with versions, loose mentions
CONFIDENCE = {FULL: 1.0, NAMED: 0.8, HINT: 0.5}
BASE_CONFIDENCE = 0.5


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str  # stands, at the start of a word, in every match of the pattern
    priority: int
    pattern: str


# Licence names as words, by keyword. Each entry: label stem, name pattern, versions, tag stem. Hand-written.
VERSIONED = [
    ("gpl", "gnu", "gnu general public licen[cs]e", "1 2 3", "gpl"),
    ("lgpl", "gnu", "gnu (?:lesser|library) general public licen[cs]e", "2 2.1 3", "lgpl"),
    ("agpl", "gnu", "gnu affero general public licen[cs]e", "1 3", "agpl"),
    ("gfdl", "free documentation", "gnu free documentation licen[cs]e", "1.1 1.2 1.3", "gfdl"),
    ("apache", "apache", "apache (?:software )?licen[cs]e", "1.0 1.1 2.0", "apache"),
    ("mpl", "mozilla", "mozilla public licen[cs]e", "1.0 1.1 2.0", "mpl"),
    ("epl", "eclipse", "eclipse public licen[cs]e", "1.0 2.0", "epl"),
    ("cddl", "common development", "common development and distribution licen[cs]e", "1.0 1.1", "cddl"),
    ("cpl", "common public", "common public licen[cs]e", "1.0", "cpl"),
    ("eupl", "european union", "european union public licen[cs]e", "1.0 1.1 1.2", "eupl"),
    ("osl", "open software", "open software licen[cs]e", "1.0 2.0 2.1 3.0", "osl"),
    ("afl", "academic free", "academic free licen[cs]e", "1.1 2.0 2.1 3.0", "afl"),
    ("artistic", "artistic", "artistic licen[cs]e", "1.0 2.0", "artistic"),
    ("bsl", "boost", "boost software licen[cs]e", "1.0", "bsl"),
    ("ofl", "sil open", "sil open font licen[cs]e", "1.0 1.1", "ofl"),
    ("lppl", "latex project", "latex project public licen[cs]e", "1.0 1.1 1.2 1.3a 1.3c", "lppl"),
    ("zpl", "zope", "zope public licen[cs]e", "1.1 2.0 2.1", "zpl"),
    ("php", "php", "php licen[cs]e", "3.0 3.01", "php"),
    ("python", "python", "python (?:software foundation )?licen[cs]e", "2.0", "python"),
    ("ecl", "educational community", "educational community licen[cs]e", "1.0 2.0", "ecl"),
    ("cecill", "cecill", "cecill(?: free software)? licen[cs]e(?: agreement)?", "1.0 1.1 2.0 2.1", "cecill"),
    ("upl", "universal permissive", "universal permissive licen[cs]e", "1.0", "upl"),
    ("ms-pl", "microsoft public", "microsoft public licen[cs]e", "1.0", "ms pl"),
    ("odbl", "database licen", "open (?:data commons )?(?:open )?database licen[cs]e", "1.0", "odbl"),
    ("odc-by", "open data commons", "open data commons attribution licen[cs]e", "1.0", "odc by"),
    ("elastic", "elastic", "elastic licen[cs]e", "1.0 2.0", "elastic"),
    ("busl", "business source", "business source licen[cs]e", "1.0 1.1", "busl"),
    ("sspl", "server side", "server side public licen[cs]e", "1", "sspl"),
]
# Creative Commons terms: tag, spelled-out name.
CREATIVE = [
    ("by", "attribution"),
    ("by-sa", "attribution share ?alike"),
    ("by-nd", "attribution no ?deriv(?:ative)?s?(?: works)?"),
    ("by-nc", "attribution non ?commercial"),
    ("by-nc-sa", "attribution non ?commercial share ?alike"),
    ("by-nc-nd", "attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?"),
]
CREATIVE_VERSIONS = "1.0 2.0 2.5 3.0 4.0"
# Single signatures. Hand-written.
SINGLE = [
    ("mit", "permission is hereby granted", FULL, "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "mit license", NAMED, "(?:the )?mit license"),
    ("mit", "mit licence", NAMED, "(?:the )?mit licence"),
    ("mit", "spdx", FULL, "spdx license identifier mit"),
    ("isc", "permission to use", FULL, "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", "isc license", NAMED, "isc license"),
    ("isc", "spdx", FULL, "spdx license identifier isc"),
    ("bsd", "redistribution and use", FULL, "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-2-clause", "bsd", NAMED, "bsd 2 clause(?: license)?"),
    ("bsd-3-clause", "bsd", NAMED, "bsd 3 clause(?: license)?"),
    ("bsd-4-clause", "bsd", NAMED, "bsd 4 clause(?: license)?"),
    ("bsd-2-clause", "simplified bsd", NAMED, "simplified bsd license"),
    ("bsd-3-clause", "revised bsd", NAMED, "(?:new or )?revised bsd license"),
    ("bsd", "bsd", HINT, "bsd (?:style )?licen[cs]ed?"),
    ("zlib", "zlib", NAMED, "zlib license"),
    ("zlib", "implied warranty", FULL, "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("unlicense", "unencumbered", FULL, "this is free and unencumbered software released into the public domain"),
    ("unlicense", "unlicense", NAMED, "(?:the )?unlicense"),
    ("wtfpl", "what the", FULL, "do what the fuck you want to public license"),
    ("cc0", "cc0", NAMED, "cc0(?: 1 0)?(?: universal)?"),
    ("cc0", "no rights reserved", NAMED, "no rights reserved"),
    ("public-domain", "public domain", NAMED, "(?:dedicated to|released into|placed in|in) the public domain"),
    ("public-domain", "public domain", HINT, "public domain"),
    ("apache-2.0", "apache", FULL, "licensed under the apache license version 2 0"),
    ("apache", "apache", HINT, "apache licen[cs]ed?"),
    ("gpl", "gnu", HINT, "gnu (?:gpl|general public licen[cs]e)"),
    ("lgpl", "general public licen", HINT, "(?:lesser|library) general public licen[cs]e"),
    ("agpl", "affero", HINT, "affero general public licen[cs]e"),
    ("gpl", "gpl", HINT, "gpl"),
    ("lgpl", "lgpl", HINT, "lgpl"),
    ("agpl", "agpl", HINT, "agpl"),
    ("gpl-notice", "free software", FULL, "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl-notice", "free software", FULL, "this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("mpl-notice", "mozilla", FULL, "this source code form is subject to the terms of the mozilla public license"),
    ("mpl", "mpl", HINT, "mpl"),
    ("epl", "epl", HINT, "epl v?\\d"),
    ("creative-commons", "creative commons", HINT, "creative commons(?: licen[cs]e)?"),
    ("reserved", "rights reserved", NAMED, "(?:all|some) rights reserved"),
    ("copyright", "copyright", HINT, "copyright(?: c)? (?:19|20)\\d\\d(?: (?:19|20)\\d\\d)?"),
    ("proprietary", "proprietary", NAMED, "proprietary and confidential"),
    ("proprietary", "unauthorized copying", NAMED, "unauthorized copying of this file"),
    ("proprietary", "proprietary", HINT, "proprietary licen[cs]e"),
    ("no-redistribution", "may not be", NAMED, "may not be (?:reproduced|copied|redistributed)(?: or (?:reproduced|copied|redistributed|distributed))*"),
    ("permission", "by permission", HINT, "(?:used|reprinted|reproduced) by permission"),
    ("terms-of-use", "terms of", HINT, "terms of (?:use|service)"),
    ("licensed", "licensed under", HINT, "licensed under(?: the)?"),
    ("beerware", "beer", FULL, "the beer ware license"),
    ("vim", "vim", NAMED, "vim license"),
    ("ruby", "ruby", NAMED, "ruby license"),
    ("ncsa", "ncsa", NAMED, "(?:university of illinois )?ncsa(?: open source license)?"),
    ("postgresql", "postgresql", NAMED, "postgresql license"),
    ("openssl", "openssl", NAMED, "openssl license"),
    ("json", "good not evil", FULL, "the software shall be used for good not evil"),
    ("curl", "curl", NAMED, "curl license"),
    ("qpl", "q public", NAMED, "q public license"),
    ("ogl-uk", "open government", NAMED, "open government licen[cs]e"),
]


def _words(version: str) -> str:
    return version.replace(".", " ")


def build_rules() -> list[Rule]:
    """All signatures in order of priority, then of this list."""
    rules = [Rule(label, keyword, priority, pattern) for label, keyword, priority, pattern in SINGLE]
    for label, keyword, name, versions, tag in VERSIONED:
        rules.append(Rule(label, keyword, NAMED, name))
        for version in versions.split():
            said = _words(version).removesuffix(" 0") + ("(?: 0)?" if version.endswith(".0") or "." not in version else "")
            own = f"{label}-{version}"
            rules.append(Rule(own, keyword, NAMED, f"{name} (?:version |v)?{said}"))
            rules.append(Rule(f"{own}-or-later", keyword, FULL, f"{name} (?:version |v)?{said} or (?:any )?later(?: version)?"))
            rules.append(Rule(own, "spdx", FULL, f"spdx license identifier {tag} {_words(version)}(?: only)?"))
            rules.append(Rule(f"{own}-or-later", "spdx", FULL, f"spdx license identifier {tag} {_words(version)} or later"))
            rules.append(Rule(own, tag, HINT, f"{tag} ?v?{said}"))
    for tag, name in CREATIVE:
        words = tag.replace("-", " ")
        rules.append(Rule(f"cc-{tag}", "creative commons", NAMED, f"creative commons {name}(?: licen[cs]e)?"))
        rules.append(Rule(f"cc-{tag}", f"cc {words}", NAMED, f"cc {words}"))
        for version in CREATIVE_VERSIONS.split():
            own = f"cc-{tag}-{version}"
            rules.append(Rule(own, f"cc {words}", FULL, f"cc {words} {_words(version)}"))
            rules.append(Rule(own, "creative commons", FULL, f"creative commons {name} {_words(version)}(?: (?:international|generic|unported))?(?: licen[cs]e)?"))
            rules.append(Rule(own, "creativecommons", FULL, f"creativecommons org licenses {words} {_words(version)}"))
    return sorted(rules, key=lambda r: r.priority)


RULES = build_rules()


def spaced_words(text: Column) -> Column:
    """The words with one space around each, A-Z lowered; a single space for a text without words."""
    joined = F.regexp_replace(F.coalesce(text, F.lit("")), SEPARATORS, " ")
    return lower_ascii(F.concat(F.lit(" "), F.trim(joined), F.lit(" ")))


def _places(words: str, phrase: str) -> Column:
    """Numbers of the words at which a phrase stands in an array of words."""
    wanted = phrase.split(" ")
    size = F.size(words)
    at = lambda i: [F.element_at(words, (i + k + 1).cast("int")) == word for k, word in enumerate(wanted)]

    def stands(i):
        parts = at(i)
        for part in parts[1:]:
            parts[0] = parts[0] & part
        return parts[0]

    indexes = F.when(size >= len(wanted), F.sequence(F.lit(0), size - len(wanted))).otherwise(F.array().cast("array<int>"))
    return F.filter(indexes, stands)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every document.

    Null and empty texts, and texts without words, have no places and empty label lists; the score is the confidence of the
    best match, 0 without one. Repeated rows are scanned each. Whole texts of any length are read. Other columns are not
    read; an empty table gives an empty result. Matches of equal span: the better priority, then the
    earlier rule, suppresses the rest. Base labels stay whatever suppresses them.
    """
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", spaced_words(F.col("text")).alias("words"))
    keywords = sorted({r.keyword for r in RULES})
    hit = F.filter(F.array(*[F.when(F.contains("words", F.lit(f" {k}")), F.lit(i)) for i, k in enumerate(keywords)]), lambda x: x.isNotNull())
    # one pass over the texts; only those with a keyword keep their words
    spaces = F.length("words") - F.length(F.replace("words", F.lit(" ")))
    n_words = F.when(F.trim("words") == "", 0).otherwise(spaces - 1).cast("bigint")
    counted = rows.select("row", "doc_id", n_words.alias("n_words"), hit.alias("hits"), "words")
    counted = counted.withColumn("words", F.when(F.size("hits") > 0, F.col("words")))
    counted = stage(counted, "licence_words")

    listed = counted.filter("words is not null").select("row", "words", F.split(F.trim("words"), " ").alias("list"), "hits")
    places = [_places("list", phrase) for phrase, _ in BASE]
    base = listed.select("row", *[p.alias(f"at{i}") for i, p in enumerate(places)])
    every = F.concat(*[F.col(f"at{i}") for i in range(len(BASE))])
    labels = F.array_compact(F.array(*[F.when(F.size(f"at{i}") > 0, F.lit(label)) for i, (_, label) in enumerate(BASE)]))
    base = base.select("row", F.size(every).cast("bigint").alias("n_base"), F.array_min(every).cast("bigint").alias("first_word"), F.array_max(every).cast("bigint").alias("last_word"), F.array_sort(labels).alias("base"))

    number = {k: i for i, k in enumerate(keywords)}
    signatures = spark.createDataFrame([(i, number[r.keyword], r.label, r.priority, f" {r.pattern}(?= )") for i, r in enumerate(RULES)], "rule int, keyword int, label string, priority int, pattern string")
    tried = listed.select("row", "words", F.explode("hits").alias("keyword")).join(F.broadcast(signatures), "keyword")  # a row per rule: hundreds
    pieces = F.split("words", F.col("pattern"), -1)
    found = tried.filter(F.expr("words rlike pattern")).withColumns({"pieces": pieces, "matches": F.regexp_extract_all("words", F.col("pattern"), F.lit(0))})
    lengths = F.transform("matches", lambda m, i: F.struct(F.length(F.element_at("pieces", i + 1)).alias("gap"), F.length(m).alias("own")))
    lengths = found.select("row", "rule", "label", "priority", F.posexplode(lengths).alias("nth", "of"))
    # a match ends where the texts before, between and of the matches so far end
    so_far = W.partitionBy("row", "rule").orderBy("nth").rowsBetween(W.unboundedPreceding, 0)
    spans = lengths.withColumn("end", F.sum(F.col("of.gap") + F.col("of.own")).over(so_far)).withColumn("start", F.col("end") - F.col("of.own"))
    return _resolved(counted, base, spans.select("row", "rule", "label", "priority", "start", "end"))


def _resolved(counted: DataFrame, base: DataFrame, spans: DataFrame) -> DataFrame:
    """Suppress contained matches per document and put the results together.

    One pass over the matches of a text by start, then falling end, priority and rule: whatever can contain a match comes before
    it, so it is contained if the furthest end so far of its priority or a better one reaches its own.
    """
    before = W.partitionBy("row").orderBy("start", F.desc("end"), "priority", "rule").rowsBetween(W.unboundedPreceding, -1)
    reach = [F.max(F.when(F.col("priority") <= p, F.col("end"))).over(before) for p in (FULL, NAMED, HINT)]
    furthest = F.element_at(F.array(*reach), F.col("priority"))
    kept = spans.withColumn("furthest", furthest).filter("furthest is null or furthest < end")
    kept = kept.groupBy("row").agg(F.collect_set("label").alias("more"), F.min("priority").alias("best"))  # labels are hundreds
    confidence = F.element_at(F.array(*[F.lit(CONFIDENCE[p]) for p in (FULL, NAMED, HINT)]), F.col("best"))
    kept = kept.select("row", "more", confidence.alias("confidence"))
    joined = counted.select("row", "doc_id", "n_words").join(base, "row", "left").join(kept, "row", "left")
    none = F.array().cast("array<string>")
    own, more = F.coalesce("base", none), F.coalesce("more", none)
    score = F.greatest(F.coalesce("confidence", F.lit(0.0)), F.when(F.col("n_base") > 0, BASE_CONFIDENCE).otherwise(0.0))
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"),
        "first_word",
        "last_word",
        F.array_join(own, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(own, more))), ",").alias("labels"),
        score.alias("score"),
    )


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence labels of all documents."""
    return scan(table(spark, sf_dir, "documents"))
