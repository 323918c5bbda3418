"""Licence scans: sentences become identifiers, identifier sequences match ordered rules.

A text is parted into sentences at blank lines, before copyright lines and after full stops;
wrapped lines and their comment marks are joined. A sentence is normalised
(lower case, anything but letters and digits is one space), and all known licence sentences
in it are found, also two licences named together. The identifiers of a document, in text order, form a sequence. Rules are
tried in order; a rule is a sequence of identifiers that must follow one another with at
most a few other identifiers in between, and what it matches is used up. Identifiers no
rule used are reported as they are.

Built-in functions only, inside the row. Texts without any licence word are passed by.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A sentence can only be a licence sentence with one of these in it.
CUES = (
    r"(?i)licen[cs]e|copyright|permission|redistribut|warrant|public domain|free software"
    r"|rights reserved|name of|version [23] of|\bcc0?\b|creative commons"
)

# Known sentences: identifier and a regular expression on the normalised sentence.
SENTENCES: dict[str, str] = {
    "apache2_named": r"\blicen[cs]ed under (?:the )?apache licen[cs]e,? version 2 0",
    "apache2_comply": r"you may not use this file except in compliance with the licen[cs]e",
    "apache2_asis": r"unless required by applicable law .* distributed under the licen[cs]e is distributed on an as is",
    "mit_named": r"\b(?:released|licen[cs]ed|available|distributed) under (?:the )?(?:terms of the )?mit licen[cs]e",
    "mit_grant": r"permission is hereby granted free of charge to any person obtaining a copy of this software",
    "mit_notice": r"the above copyright notice and this permission notice shall be included",
    "asis_software": r"the software is provided as is without warranty of any kind",
    "bsd_named": r"\b(?:released|licen[cs]ed|available|distributed) under (?:the|a) (?:[234] clause )?(?:new |modified |simplified )?bsd(?: [234] clause)?(?: style)? licen[cs]e",
    "bsd_use": r"redistribution and use in source and binary forms with or without modification are permitted",
    "bsd_source": r"redistributions of source code must retain the above copyright notice",
    "bsd_binary": r"redistributions in binary form must reproduce the above copyright notice",
    "bsd_names": r"neither the name of .* may be used to endorse or promote products",
    "bsd_asis": r"this software is provided by .* as is and any express or implied warranties",
    "gpl3_named": r"\b(?:gnu )?general public licen[cs]e,? version 3",
    "gpl2_named": r"\b(?:gnu )?general public licen[cs]e,? version 2",
    "lgpl_named": r"\blicen[cs]ed under (?:the )?(?:gnu )?lesser general public licen[cs]e",
    "agpl_named": r"\blicen[cs]ed under (?:the )?(?:gnu )?affero general public licen[cs]e",
    "gpl_free": r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e",
    "gpl_later": r"either version [23] of the licen[cs]e or at your option any later version",
    "gpl_warranty": r"this program is distributed in the hope that it will be useful but without any warranty",
    "mpl2_named": r"mozilla public licen[cs]e,? v(?:ersion)? 2 0",
    "cc_by_nc": r"\b(?:cc|creative commons) (?:by nc|attribution non ?commercial) 4 0",
    "cc_by_sa": r"\b(?:cc|creative commons) (?:by sa|attribution share ?alike) 4 0",
    "cc_by": r"\b(?:cc|creative commons) (?:by|attribution) 4 0",
    "cc0": r"\b(?:cc0|creative commons zero)\b",
    "public_domain": r"\b(?:dedicated to|placed in|released into) the public domain",
    "all_rights": r"all rights reserved",
    "copyright": r"^copyright (?:c )?(?:19|20)[0-9]{2}\b",
}

# Licences in the order they are tried, each with the identifiers that make it up.
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Apache-2.0", ("apache2_named", "apache2_comply", "apache2_asis")),
    ("Apache-2.0", ("apache2_named",)),
    ("MIT", ("mit_grant", "mit_notice", "asis_software")),
    ("MIT", ("mit_grant", "mit_notice")),
    ("MIT", ("mit_named",)),
    ("BSD-3-Clause", ("bsd_use", "bsd_source", "bsd_binary", "bsd_names", "bsd_asis")),
    ("BSD-3-Clause", ("bsd_use", "bsd_source", "bsd_binary", "bsd_names")),
    ("BSD-2-Clause", ("bsd_use", "bsd_source", "bsd_binary", "bsd_asis")),
    ("BSD-2-Clause", ("bsd_use", "bsd_source", "bsd_binary")),
    ("BSD", ("bsd_named",)),
    ("GPL-or-later", ("gpl_free", "gpl_later", "gpl_warranty")),
    ("GPL-or-later", ("gpl_free", "gpl_later")),
    ("AGPL", ("agpl_named",)),
    ("LGPL", ("lgpl_named",)),
    ("GPL-3.0", ("gpl3_named",)),
    ("GPL-2.0", ("gpl2_named",)),
    ("MPL-2.0", ("mpl2_named",)),
    ("CC-BY-NC-4.0", ("cc_by_nc",)),
    ("CC-BY-SA-4.0", ("cc_by_sa",)),
    ("CC-BY-4.0", ("cc_by",)),
    ("CC0-1.0", ("cc0",)),
    ("Public-Domain", ("public_domain",)),
)

# SPDX lines: identifier, normalised name and licence. Other names are reported as they are.
_SPDX: tuple[tuple[str, str, str], ...] = (
    ("spdx_apache2", r"apache 2 0\b", "Apache-2.0"),
    ("spdx_mit", r"mit\b(?! 0)", "MIT"),
    ("spdx_bsd3", r"bsd 3 clause\b", "BSD-3-Clause"),
    ("spdx_bsd2", r"bsd 2 clause\b", "BSD-2-Clause"),
    ("spdx_agpl", r"agpl [13] 0\b", "AGPL"),
    ("spdx_lgpl", r"lgpl [23] [01]\b", "LGPL"),
    ("spdx_gpl3", r"gpl 3 0\b", "GPL-3.0"),
    ("spdx_gpl2", r"gpl 2 0\b", "GPL-2.0"),
    ("spdx_mpl2", r"mpl 2 0\b", "MPL-2.0"),
    ("spdx_cc_by_nc", r"cc by nc 4 0\b", "CC-BY-NC-4.0"),
    ("spdx_cc_by_sa", r"cc by sa 4 0\b", "CC-BY-SA-4.0"),
    ("spdx_cc_by", r"cc by 4 0\b", "CC-BY-4.0"),
    ("spdx_cc0", r"cc0 1 0\b", "CC0-1.0"),
    ("spdx_other", r"[a-z0-9]+\b", ""),
)
_OWN_GPL = r"(?<!lesser )(?<!library )(?<!affero )\bgeneral public licen[cs]e,? v(?:ersion )?"
# What is looked up: no plain GPL within the lesser and the Affero one, and SPDX names.
KNOWN: dict[str, str] = SENTENCES | {
    "apache2_asis": r"unless required by applicable law .*? distributed under the licen[cs]e is distributed on an as is",
    "bsd_names": r"neither the name of .*? may be used to endorse or promote products",
    "bsd_asis": r"this software is provided by .*? as is and any express or implied warranties",
    "gpl3_named": _OWN_GPL + "3",
    "gpl2_named": _OWN_GPL + "2",
    "lgpl_named": r"\b(?:lesser|library) general public licen[cs]e",
    "agpl_named": r"\baffero general public licen[cs]e",
} | {name: rf"\bspdx license identifier {p}" for name, p, _ in _SPDX}
ALL_RULES = RULES + tuple((licence, (name,)) for name, _, licence in _SPDX if licence)

# Wrapped lines belong together, whatever comment marks they begin with. Texts are cut at
# lines without letters and digits, before copyright lines, and after full stops.
_CUT = (
    r"\n[^A-Za-z0-9\n]*(?=\n)"
    r"|\n(?=[^A-Za-z0-9\n]*(?i:copyright[^a-z0-9]+(?:c[^a-z0-9]+)?)(?:19|20)[0-9]{2}\b)"
    r"|(?<=[.!?])[\x09-\x0D\x20]+(?=[^a-z])"
)
_WRAPPED_CUES = CUES.replace(" ", r"[^a-z0-9]+(?:(?:dnl|rem)[^a-z0-9]+)?")

_NAMED = r"\b(?:released|licen[cs]ed|available|distributed) under\b"
_NEXT = r"(?:apache|mit|(?:[234] clause |new |modified |simplified )?bsd)\b"


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))


def _each_named(sentence: Column) -> Column:
    """A normalised sentence with what leads up to the first of its licences before each."""
    tag = "spdx license identifier "
    one = F.regexp_replace(sentence, r"\bunder either (?:of )?", "under ")
    one = F.regexp_replace(
        one,
        rf"\b(licen[cs]e(?: v?(?:ersion )?[0-9](?: [0-9])?)?) (?:and |or )+"
        rf"(?:at your option )?(?:under )?(?:the )?(?:terms of the )?(?={_NEXT})",
        "$1 or licensed under the ",
    )
    return (
        F.when(
            sentence.startswith(tag), F.regexp_replace(sentence, r"\b(?:or|and) (?!later\b)", tag)
        )
        .when(sentence.rlike(_NAMED), one)
        .otherwise(sentence)
    )


def names_in(sentence: Column, known: Mapping[str, str]) -> Column:
    """All identifiers whose expressions a normalised sentence holds, in order of place.

    Expressions may overlap; of those beginning at one place the first counts.
    """
    held = F.regexp_extract_all(
        _each_named(sentence), F.lit("(?=(" + "|".join(known.values()) + "))"), F.lit(1)
    )
    return F.transform(
        held,
        lambda piece: F.coalesce(
            *[F.when(piece.rlike(f"^(?:{p})$"), F.lit(name)) for name, p in known.items()]
        ),
    )


def identifiers(text: Column, known: Mapping[str, str] = KNOWN) -> Column:
    """Identifiers of a text's licence sentences, in text order."""
    lines = F.regexp_replace(text, r"\r\n?", "\n")
    lines = F.regexp_replace(lines, r"(?im)^[^a-z0-9\n]*(?:dnl|rem)\b", "")
    tagged = F.regexp_replace(lines, r"(?i)\b(spdx-license-identifier:[^\n]*)", "\n\n$1\n")
    sentences = F.filter(F.split(tagged, _CUT), lambda s: s.rlike(_WRAPPED_CUES))
    names = F.flatten(F.transform(sentences, lambda s: names_in(normalised(s), known)))
    return F.array_compact(names)


def _pattern(rule: Sequence[str], gap: int) -> str:
    between = f"(?:[a-z0-9_]+ ){{0,{gap}}}?"
    return "(?<= )" + between.join(f"{name} " for name in rule)


def scan_licences(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    known: Mapping[str, str] = KNOWN,
    rules: Sequence[tuple[str, Sequence[str]]] = ALL_RULES,
    gap: int = 2,
) -> DataFrame:
    """One row per row of ``docs``: n_sentences, licences and unmatched identifiers.

    ``licences`` are distinct names in rule order, ``unmatched`` identifiers in text order,
    both joined by commas. NULL and empty texts have none. Repeated rows are scanned each;
    an empty table gives no rows; other columns are not looked at.
    """
    text = F.coalesce(F.col("__text"), F.lit(""))
    none = F.array().cast("array<string>")
    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.col(text_column).alias("__text")
    ).withColumn("__ids", F.when(text.rlike(_WRAPPED_CUES), identifiers(text, known)).otherwise(none))
    start = F.struct(
        F.concat(F.lit(" "), F.array_join("__ids", " "), F.lit(" ")).alias("rest"),
        none.alias("names"),
    )
    table = F.array(
        *[
            F.struct(F.lit(name).alias("name"), F.lit(_pattern(rule, gap)).alias("p"))
            for name, rule in rules
        ]
    )
    matched = F.aggregate(
        table,
        start,
        lambda acc, rule: F.struct(
            F.regexp_replace(acc["rest"], rule["p"], F.lit("# ")).alias("rest"),
            F.when(
                F.regexp_like(acc["rest"], rule["p"]), F.array_append(acc["names"], rule["name"])
            ).otherwise(acc["names"]).alias("names"),
        ),
    )
    result = rows.withColumn(
        "__found", F.when(F.size("__ids") > 0, matched).otherwise(start)
    )
    left = F.filter(F.split(F.trim("__found.rest"), " "), lambda x: ~x.isin("#", ""))
    return result.select(
        "doc_id", F.size("__ids").cast("long").alias("n_sentences"),
        F.array_join(F.array_distinct("__found.names"), ",").alias("licences"),
        F.array_join(left, ",").alias("unmatched"),
    )
