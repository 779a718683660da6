"""License scans with ordered signature rules, in DataFrame functions only.

Rules are regular expressions over the lower-cased text, made from a table of licences
and the ways a text names one. A text is looked at further only if it holds a keyword of
any rule; of the rules, only those run whose own keyword it holds. Each rule gives the
intervals it matches, with a priority and a confidence; an interval that lies inside one
of higher priority, or inside a longer one of its own priority, is suppressed.

Everything is computed inside the row, so there is no shuffle and no key to be skewed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Base phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# FIXED VALUES: label, ways to spell its name (a word that every match holds, pattern), SPDX ids as a pattern, address as a pattern.
# A keyword has no white space: the patterns allow any of it between words.
LICENSES = (
    ("mit", (("mit", r"(?:the )?mit"), ("expat", r"(?:the )?expat")), r"mit", r"opensource\.org/licenses/mit"),
    ("apache-1.1", (("apache", r"(?:the )?apache(?: software)?(?: license)?,? (?:version |v\.? ?)?1\.1"),), r"apache-1\.1", r"apache\.org/licenses/license-1\.1"),
    ("apache-2.0", (("apache", r"(?:the )?apache(?: software)?(?: license)?,? (?:version |v\.? ?)?2(?:\.0)?"),), r"apache-2\.0", r"apache\.org/licenses/license-2\.0"),
    ("gpl-1.0", (("general", r"(?:the )?(?:gnu )?general public licen[sc]e,? (?:version |v\.? ?)?1(?:\.0)?"),), r"gpl-1\.0(?:-only|-or-later|\+)?", r"gnu\.org/licenses/(?:old-licenses/)?gpl-1\.0"),
    ("gpl-2.0", (("general", r"(?:the )?(?:gnu )?general public licen[sc]e,? (?:version |v\.? ?)?2(?:\.0)?"),), r"gpl-2\.0(?:-only|-or-later|\+)?", r"gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0"),
    ("gpl-3.0", (("general", r"(?:the )?(?:gnu )?general public licen[sc]e,? (?:version |v\.? ?)?3(?:\.0)?"),), r"gpl-3\.0(?:-only|-or-later|\+)?", r"gnu\.org/licenses/gpl-3\.0"),
    ("lgpl-2.1", (("general", r"(?:the )?(?:gnu )?(?:lesser|library) general public licen[sc]e,? (?:version |v\.? ?)?2(?:\.[01])?"),), r"lgpl-2\.[01](?:-only|-or-later|\+)?", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.[01]"),
    ("lgpl-3.0", (("general", r"(?:the )?(?:gnu )?lesser general public licen[sc]e,? (?:version |v\.? ?)?3(?:\.0)?"),), r"lgpl-3\.0(?:-only|-or-later|\+)?", r"gnu\.org/licenses/lgpl-3\.0"),
    ("agpl-3.0", (("affero", r"(?:the )?(?:gnu )?affero general public licen[sc]e(?:,? (?:version |v\.? ?)?3(?:\.0)?)?"),), r"agpl-3\.0(?:-only|-or-later|\+)?", r"gnu\.org/licenses/agpl-3\.0"),
    ("gfdl", (("documentation", r"(?:the )?(?:gnu )?free documentation licen[sc]e"),), r"gfdl-1\.[123](?:-only|-or-later)?", r"gnu\.org/licenses/fdl"),
    ("bsd-0", (("0bsd", r"(?:the )?0bsd"), ("zero", r"(?:the )?zero[- ]clause bsd")), r"0bsd", r"opensource\.org/licenses/0bsd"),
    ("bsd-2-clause", (("bsd", r"(?:the )?(?:(?:simplified|2[- ]clause|two[- ]clause) bsd|bsd[- ]2(?:[- ]clause)?)"),), r"bsd-2-clause", r"opensource\.org/licenses/bsd-2-clause"),
    ("bsd-3-clause", (("bsd", r"(?:the )?(?:(?:new|revised|modified|3[- ]clause|three[- ]clause) bsd|bsd[- ]3(?:[- ]clause)?)"),), r"bsd-3-clause", r"opensource\.org/licenses/bsd-3-clause"),
    ("bsd-4-clause", (("bsd", r"(?:the )?(?:(?:original|4[- ]clause|four[- ]clause) bsd|bsd[- ]4(?:[- ]clause)?)"),), r"bsd-4-clause", r"opensource\.org/licenses/bsd-4-clause"),
    ("mpl-1.1", (("mozilla", r"(?:the )?mozilla public licen[sc]e,? (?:version |v\.? ?)?1\.1"),), r"mpl-1\.1", r"mozilla\.org/mpl/1\.1"),
    ("mpl-2.0", (("mozilla", r"(?:the )?mozilla public licen[sc]e,? (?:version |v\.? ?)?2(?:\.0)?"),), r"mpl-2\.0", r"mozilla\.org/mpl/2\.0"),
    ("epl-1.0", (("eclipse", r"(?:the )?eclipse public licen[sc]e,? (?:version |v\.? ?)?1(?:\.0)?"),), r"epl-1\.0", r"eclipse\.org/legal/epl-v10"),
    ("epl-2.0", (("eclipse", r"(?:the )?eclipse public licen[sc]e,? (?:version |v\.? ?)?2(?:\.0)?"),), r"epl-2\.0", r"eclipse\.org/legal/epl-(?:v20|2\.0)"),
    ("cddl", (("distribution", r"(?:the )?common development and distribution licen[sc]e"),), r"cddl-1\.[01]", r"opensource\.org/licenses/cddl"),
    ("cpl", (("common", r"(?:the )?common public licen[sc]e"),), r"cpl-1\.0", r"opensource\.org/licenses/cpl"),
    ("artistic", (("artistic", r"(?:the )?artistic licen[sc]e"),), r"artistic-[12]\.0", r"opensource\.org/licenses/artistic"),
    ("isc", (("isc", r"(?:the )?isc"),), r"isc", r"opensource\.org/licenses/isc"),
    ("zlib", (("zlib", r"(?:the )?zlib(?:/libpng)?"),), r"zlib", r"zlib\.net/zlib_license"),
    ("libpng", (("png", r"(?:the )?png reference library"), ("libpng", r"(?:the )?libpng")), r"libpng(?:-2\.0)?", r"libpng\.org/pub/png/src/libpng-license"),
    ("boost", (("boost", r"(?:the )?boost software"),), r"bsl-1\.0", r"boost\.org/license_1_0"),
    ("unlicense", (("unlicense", r"(?:the )?unlicense"),), r"unlicense", r"unlicense\.org"),
    ("wtfpl", (("wtfpl", r"(?:the )?wtfpl"),), r"wtfpl", r"wtfpl\.net"),
    ("python", (("python", r"(?:the )?python software foundation"),), r"psf-2\.0|python-2\.0", r"python\.org/psf/license"),
    ("postgresql", (("postgresql", r"(?:the )?postgresql"),), r"postgresql", r"postgresql\.org/about/licence"),
    ("openssl", (("openssl", r"(?:the )?openssl"),), r"openssl", r"openssl\.org/source/license"),
    ("openldap", (("openldap", r"(?:the )?openldap public"),), r"oldap-2\.8", r"openldap\.org/software/release/license"),
    ("ruby", (("ruby", r"(?:the )?ruby"),), r"ruby", r"ruby-lang\.org/en/about/license"),
    ("php", (("php", r"(?:the )?php(?: licen[sc]e)?,? (?:version |v\.? ?)?3\.01"),), r"php-3\.01", r"php\.net/license"),
    ("eupl", (("european", r"(?:the )?european union public licen[sc]e"),), r"eupl-1\.[12]", r"joinup\.ec\.europa\.eu/.{0,40}eupl"),
    ("cecill", (("cecill", r"(?:the )?cecill"),), r"cecill-2\.[01]", r"cecill\.info/licences"),
    ("ms-pl", (("microsoft", r"(?:the )?microsoft public licen[sc]e"),), r"ms-pl", r"opensource\.org/licenses/ms-pl"),
    ("ofl", (("font", r"(?:the )?(?:sil )?open font licen[sc]e"),), r"ofl-1\.[01]", r"scripts\.sil\.org/ofl"),
    ("odbl", (("database", r"(?:the )?open database licen[sc]e"),), r"odbl-1\.0", r"opendatacommons\.org/licenses/odbl"),
    ("odc-by", (("commons", r"(?:the )?open data commons attribution licen[sc]e"),), r"odc-by-1\.0", r"opendatacommons\.org/licenses/by"),
    ("cc0", (("cc0", r"(?:the )?(?:creative commons )?cc0(?:[- ]1\.0)?"), ("zero", r"(?:the )?(?:creative commons )?cc zero(?:[- ]1\.0)?")), r"cc0-1\.0", r"creativecommons\.org/publicdomain/zero"),
    ("cc-by", (("creative", r"(?:a |the )?creative commons attribution(?: [1-4]\.0)?"), ("cc", r"(?:a |the )?cc[- ]by(?: [1-4]\.0)?")), r"cc-by-[1-4]\.0", r"creativecommons\.org/licenses/by/"),
    ("cc-by-sa", (("creative", r"(?:a |the )?creative commons attribution[- ]share ?alike(?: [1-4]\.0)?"), ("cc", r"(?:a |the )?cc[- ]by[- ]sa(?: [1-4]\.0)?")), r"cc-by-sa-[1-4]\.0", r"creativecommons\.org/licenses/by-sa"),
    ("cc-by-nc", (("creative", r"(?:a |the )?creative commons attribution[- ]non ?commercial(?: [1-4]\.0)?"), ("cc", r"(?:a |the )?cc[- ]by[- ]nc(?: [1-4]\.0)?")), r"cc-by-nc-[1-4]\.0", r"creativecommons\.org/licenses/by-nc/"),
    ("cc-by-nd", (("creative", r"(?:a |the )?creative commons attribution[- ]no ?derivatives(?: [1-4]\.0)?"), ("cc", r"(?:a |the )?cc[- ]by[- ]nd(?: [1-4]\.0)?")), r"cc-by-nd-[1-4]\.0", r"creativecommons\.org/licenses/by-nd/"),
    ("cc-by-nc-sa", (("creative", r"(?:a |the )?creative commons attribution[- ]non ?commercial[- ]share ?alike(?: [1-4]\.0)?"), ("cc", r"(?:a |the )?cc[- ]by[- ]nc[- ]sa(?: [1-4]\.0)?")), r"cc-by-nc-sa-[1-4]\.0", r"creativecommons\.org/licenses/by-nc-sa"),
    ("cc-by-nc-nd", (("creative", r"(?:a |the )?creative commons attribution[- ]non ?commercial[- ]no ?derivatives(?: [1-4]\.0)?"), ("cc", r"(?:a |the )?cc[- ]by[- ]nc[- ]nd(?: [1-4]\.0)?")), r"cc-by-nc-nd-[1-4]\.0", r"creativecommons\.org/licenses/by-nc-nd"),
)
#: Ways a text names a licence: what stands around the name, priority, confidence.
WAYS = (
    (r"\blicen[sc]ed under (?:the terms of )?{name}(?: licen[sc]e)?\b", 3, 0.95),
    (r"\b(?:re)?(?:released|distributed|published|available|provided) under (?:the terms of )?{name}(?: licen[sc]e)?\b", 3, 0.9),
    (r"\bsubject to (?:the terms (?:and conditions )?of )?{name}(?: licen[sc]e)?\b", 2, 0.8),
    (r"\b{name} licen[sc]e\b", 1, 0.6),
)
SPDX = (r"\bspdx-license-identifier:\s*(?:{spdx})(?![\w.+-])", 4, 1.0)
ADDRESS = (r"\bhttps?://(?:www\.)?{address}", 4, 0.9)
# FIXED VALUES: rules that belong to no single licence (label, keyword, pattern, priority, confidence)
GENERAL = (
    ("gpl", "general", r"\b(?:gnu )?general public licen[sc]e\b", 1, 0.6),
    ("lgpl", "general", r"\b(?:lesser|library) general public licen[sc]e\b", 2, 0.6),
    ("apache", "apache", r"\bapache licen[sc]e\b", 1, 0.6),
    ("cc", "creative", r"\bcreative commons(?: licen[sc]e)?\b", 0, 0.4),
    ("public-domain", "domain", r"\b(?:dedicated to|placed in(?:to)?|released into) the public domain\b", 2, 0.8),
    ("proprietary", "reserved", r"\ball rights reserved\b", 0, 0.3),
    ("proprietary", "proprietary", r"\bproprietary and confidential\b", 2, 0.7),
    ("mit", "hereby", r"\bpermission is hereby granted, free of charge, to any person obtaining a copy\b", 4, 1.0),
    ("bsd", "redistribution", r"\bredistribution and use in source and binary forms\b", 4, 0.9),
)


def rules() -> list[tuple[str, str, str, int, float]]:
    """(label, keyword, pattern, priority, confidence) of every rule, in order; spaces match any run of white space."""
    out = []
    for label, names, spdx, address in LICENSES:
        out += [(label, keyword, way.format(name=f"(?:{name})"), p, c) for keyword, name in names for way, p, c in WAYS]
        out.append((label, "spdx-license", SPDX[0].format(spdx=spdx), *SPDX[1:]))
        out.append((label, "http", ADDRESS[0].format(address=address), *ADDRESS[1:]))
    out += list(GENERAL)
    return [(a, k, p.replace("[- ]", r"[-\s]").replace(" ?", r"\s*").replace(" ", r"\s+"), n, c) for a, k, p, n, c in out]


def _spaces(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


def _lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _present(text: Column) -> Column:
    """The keywords of rules that the text holds: each is searched once, however many rules have it."""
    return F.filter(F.array(*[F.lit(k) for k in sorted({r[1] for r in rules()})]), lambda k: F.contains(text, k))


def _detections(text: Column, present: Column) -> Column:
    """Array of (start, -end, -priority, rule, label, confidence) of all rules whose keyword is present."""
    table = F.array(*[F.struct(F.lit(i).alias("rule"), F.lit(a).alias("label"), F.lit(k).alias("keyword"), F.lit(p).alias("pattern"),
                               F.lit(n).alias("priority"), F.lit(c).alias("confidence")) for i, (a, k, p, n, c) in enumerate(rules())])

    def intervals(rule: Column) -> Column:
        between = F.transform(F.split(text, rule["pattern"], -1), F.length)
        matched = F.transform(F.regexp_extract_all(text, rule["pattern"], F.lit(0)), F.length)
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("found"))
        walk = F.aggregate(
            F.arrays_zip(between.alias("b"), matched.alias("m")), start,
            lambda s, x: F.struct(
                (s["at"] + x["b"] + F.coalesce(x["m"], F.lit(0))).alias("at"),
                F.when(x["m"].isNull(), s["found"]).otherwise(F.concat(s["found"], F.array(F.struct(
                    (s["at"] + x["b"]).alias("start"), (s["at"] + x["b"] + x["m"]).alias("end"))))).alias("found")))
        return F.transform(walk["found"], lambda i: F.struct(
            i["start"].alias("start"), (-i["end"]).alias("minus_end"), (-rule["priority"]).alias("minus_priority"),
            rule["rule"].alias("rule"), rule["label"].alias("label"), rule["confidence"].alias("confidence")))

    held = F.filter(table, lambda r: F.array_contains(present, r["keyword"]))
    return F.array_sort(F.flatten(F.transform(held, intervals)))


def _kept(found: Column) -> Column:
    """Labels and best confidence of the intervals that are not suppressed.

    In order of start, then longest first, an interval lies inside an earlier one if its
    end is at most the largest end so far; one such end is kept for each priority.
    """
    top = max(r[3] for r in rules())
    zero = F.struct(*[F.lit(-1).alias(f"e{p}") for p in range(top + 1)],
                    F.array().cast("array<string>").alias("labels"), F.lit(0.0).alias("score"))

    # an interval of higher priority may start at the same place and be shorter or equal: equal intervals sort by priority
    def step(s: Column, d: Column) -> Column:
        end, priority = -d["minus_end"], -d["minus_priority"]
        hidden = reduce(lambda x, p: x | ((priority <= p) & (s[f"e{p}"] >= end)), range(top + 1), F.lit(False))
        return F.struct(*[F.when(priority == p, F.greatest(s[f"e{p}"], end)).otherwise(s[f"e{p}"]).alias(f"e{p}") for p in range(top + 1)],
                        F.when(hidden, s["labels"]).otherwise(F.array_union(s["labels"], F.array(d["label"]))).alias("labels"),
                        F.when(hidden, s["score"]).otherwise(F.greatest(s["score"], d["confidence"])).alias("score"))

    return F.aggregate(found, zero, step, lambda s: F.struct(s["labels"], s["score"]))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """License places and labels of each row's whole text; one row per input row.

    Columns: doc_id, n_words, n_base (places of the base phrases), first_word, last_word
    (their smallest and largest start), base_labels, labels (with the rules'), score (the
    best confidence; a base phrase counts 0.6; 0 without any).

    Null or empty text: no words and no places. A null doc_id stays null; repeated rows
    return each; an empty table gives an empty result. Extra columns are not read.
    """
    low = _lower(F.coalesce(F.col("text").cast("string"), F.lit("")))
    df = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), low.alias("low"))
    df = df.withColumn("words", F.trim(F.regexp_replace("low", WORD_GAP, " ")))
    n_words = F.when(F.col("words") == "", 0).otherwise(_spaces(F.col("words")) + 1).cast("long")
    df = df.select("doc_id", "low", n_words.alias("n_words"), F.concat(F.lit(" "), "words", F.lit(" ")).alias("padded"))
    count, first, last, labels = [], [], [], []
    for phrase, label in PHRASES:
        parts = F.split("padded", f" {phrase}(?= )", -1)
        here = F.contains("padded", F.lit(f" {phrase} "))
        count.append(F.when(here, F.size(parts) - 1).otherwise(0))
        first.append(F.when(here, _spaces(F.element_at(parts, 1))))
        last.append(F.when(here, F.col("n_words") - (_spaces(F.element_at(parts, -1)) - 1) - len(phrase.split())))
        labels.append(F.when(here, F.lit(label)))
    base = F.array_sort(F.array_compact(F.array(*labels)))
    df = df.select("doc_id", "low", "n_words", reduce(lambda a, b: a + b, count).cast("long").alias("n_base"),
                   F.least(*first).cast("long").alias("first_word"), F.greatest(*last).cast("long").alias("last_word"),
                   base.alias("base"), _present(F.col("low")).alias("present"))
    df = df.withColumn("kept", F.when(F.size("present") > 0, _kept(_detections(F.col("low"), F.col("present")))))
    every = F.array_sort(F.array_union("base", F.coalesce(F.col("kept.labels"), F.array().cast("array<string>"))))
    score = F.greatest(F.coalesce(F.col("kept.score"), F.lit(0.0)), F.when(F.col("n_base") > 0, 0.6).otherwise(0.0))
    return df.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
                     F.array_join(every, ",").alias("labels"), score.alias("score"))
