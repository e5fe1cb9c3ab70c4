"""License scans (8) in DataFrame functions alone: ordered signature rules on word-normalised text.

A text becomes its lower-cased (A-Z) words, each between two spaces (" a  b "), so a rule's pattern owns the space on
both sides of its words and matches whole words only. A rule belongs to a keyword and, where a form goes around a
name, to a hint of that form, both part of every match: rules of which a text lacks one are not tried. What the others
find are intervals; they are sorted by start, longest first, then by priority, and one that lies within an earlier one
goes. Of equal intervals the rule with the best priority stays. A text's labels are those of the intervals that stay,
and those of the base phrases, which always stay.

Null and empty texts have no words and no labels. Repeated rows fare alike. Other columns stay behind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Base phrases and labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

#: Hand-written names: label, keyword (part of every match), pattern of the name in words. `{v}` parts are versions.
NAMES = (
    ("mit", "mit", "(?:the )?mit(?: x11)?"),
    ("mit-0", "mit", "mit (?:0|no attribution)"),
    ("x11", "x11", "x11"),
    ("isc", "isc", "isc"),
    ("bsd", "bsd", "(?:modified |new |revised |simplified )?bsd"),
    ("bsd-0-clause", "bsd", "(?:0 clause bsd|zero clause bsd|bsd 0 clause|0bsd)"),
    ("bsd-2-clause", "bsd", "(?:2 clause bsd|two clause bsd|bsd 2 clause|freebsd)"),
    ("bsd-3-clause", "bsd", "(?:3 clause bsd|three clause bsd|bsd 3 clause)"),
    ("bsd-4-clause", "bsd", "(?:4 clause bsd|four clause bsd|bsd 4 clause|original bsd)"),
    ("apache-1", "apache", "apache(?: software)?(?: licen[cs]e)?(?: version)? (?:v1|1 0|1 1)"),
    ("apache-2", "apache", "apache(?: software)?(?: licen[cs]e)?(?: version)? (?:v2|2 0|2)"),
    ("apache", "apache", "apache(?: software)?"),
    ("gpl-1", "general", "gnu general public licen[cs]e(?: version)? (?:v1|1 0|1)"),
    ("gpl-2", "general", "gnu general public licen[cs]e(?: version)? (?:v2|2 0|2)"),
    ("gpl-3", "general", "gnu general public licen[cs]e(?: version)? (?:v3|3 0|3)"),
    ("gpl", "general", "(?:gnu )?general public"),
    ("gpl-2", "gpl", "(?:gnu )?(?:gpl(?: version)? (?:v2|2 0|2)|gplv2)"),
    ("gpl-3", "gpl", "(?:gnu )?(?:gpl(?: version)? (?:v3|3 0|3)|gplv3)"),
    ("gpl", "gpl", "(?:gnu )?gpl"),
    ("lgpl-2.1", "lesser", "gnu (?:lesser|library) general public licen[cs]e(?: version)? (?:v2 1|2 1)"),
    ("lgpl-3", "lesser", "gnu lesser general public licen[cs]e(?: version)? (?:v3|3 0|3)"),
    ("lgpl", "lesser", "(?:gnu )?lesser general public"),
    ("lgpl", "lgpl", "(?:gnu )?lgpl(?:v[23])?"),
    ("agpl-3", "affero", "gnu affero general public licen[cs]e(?: version)? (?:v3|3 0|3)"),
    ("agpl", "affero", "(?:gnu )?affero general public"),
    ("agpl", "agpl", "(?:gnu )?agpl(?:v3)?"),
    ("gfdl", "documentation", "gnu free documentation"),
    ("gfdl", "gfdl", "(?:gnu )?gfdl"),
    ("mpl-1.1", "mozilla", "mozilla public licen[cs]e(?: version)? (?:v1 1|1 1)"),
    ("mpl-2", "mozilla", "mozilla public licen[cs]e(?: version)? (?:v2|2 0|2)"),
    ("mpl", "mozilla", "mozilla public"),
    ("mpl", "mpl", "mpl(?: v?[12](?: [01])?)?"),
    ("epl-1", "eclipse", "eclipse public licen[cs]e(?: version)? (?:v1|1 0|1)"),
    ("epl-2", "eclipse", "eclipse public licen[cs]e(?: version)? (?:v2|2 0|2)"),
    ("epl", "eclipse", "eclipse public"),
    ("cddl", "cddl", "cddl(?: 1 [01])?"),
    ("cddl", "development", "common development and distribution"),
    ("eupl", "european", "european union public"),
    ("eupl", "eupl", "eupl(?: 1 [012])?"),
    ("artistic", "artistic", "(?:perl )?artistic(?: 2 0)?"),
    ("boost", "boost", "boost software"),
    ("zlib", "zlib", "zlib(?: libpng)?"),
    ("unlicense", "unlicense", "(?:the )?unlicense"),
    ("wtfpl", "wtfpl", "(?:the )?wtfpl"),
    ("cc0", "cc0", "cc0(?: 1 0)?"),
    ("cc0", "zero", "creative commons zero"),
    ("cc-by", "cc", "cc by(?: [1234] [05])?"),
    ("cc-by-sa", "cc", "cc by sa(?: [1234] [05])?"),
    ("cc-by-nd", "cc", "cc by nd(?: [1234] [05])?"),
    ("cc-by-nc", "cc", "cc by nc(?: [1234] [05])?"),
    ("cc-by-nc-sa", "cc", "cc by nc sa(?: [1234] [05])?"),
    ("cc-by-nc-nd", "cc", "cc by nc nd(?: [1234] [05])?"),
    ("cc-by", "creative", "creative commons attribution"),
    ("cc-by-sa", "creative", "creative commons attribution share ?alike"),
    ("cc-by-nd", "creative", "creative commons attribution no ?derivatives"),
    ("cc-by-nc", "creative", "creative commons attribution non ?commercial"),
    ("cc-by-nc-sa", "creative", "creative commons attribution non ?commercial share ?alike"),
    ("cc-by-nc-nd", "creative", "creative commons attribution non ?commercial no ?derivatives"),
    ("creative-commons", "creative", "creative commons"),
    ("python", "python", "python software foundation"),
    ("php", "php", "php"),
    ("postgresql", "postgresql", "postgresql"),
    ("openssl", "openssl", "openssl"),
    ("ofl", "font", "sil open font"),
    ("ms-pl", "microsoft", "microsoft public"),
    ("ms-rl", "microsoft", "microsoft reciprocal"),
    ("apsl", "apple", "apple public source"),
    ("ibm-public", "ibm", "ibm public"),
    ("cpl", "common", "common public"),
    ("afl", "academic", "academic free"),
    ("osl", "osl", "osl(?: 3 0)?"),
    ("osl", "software", "open software"),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa open source"),
    ("w3c", "w3c", "w3c(?: software)?"),
    ("odbl", "database", "open(?: data commons)? open database"),
    ("sspl", "side", "server side public"),
    ("busl", "business", "business source"),
    ("elastic", "elastic", "elastic(?: 2 0)?"),
)
#: Ways in which a name is used: priority (less is better), confidence, hint (part of every match), pattern around it.
FORMS = (
    (0, 1.0, "spdx", "spdx licen[cs]e identifier {}"),
    (1, 0.95, "under", "(?:licen[cs]ed|released|distributed|available|published|provided|covered|shared|dual licen[cs]ed) under (?:the )?(?:terms of )?(?:the )?{}(?: (?:public )?licen[cs]e)?"),
    (2, 0.9, "under", "under (?:the )?(?:terms of )?(?:the )?{}(?: (?:public )?licen[cs]e)"),
    (3, 0.8, "licen", "{} (?:public )?licen[cs]e(?: agreement| terms| text)?"),
)
#: Hand-written signatures of whole texts and notices: label, keyword, confidence, pattern.
NOTICES = (
    ("mit", "hereby", 1.0, "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "noninfringement", 0.7, "fitness for a particular purpose and noninfringement"),
    ("isc", "hereby", 1.0, "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistribution", 1.0, "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "endorse", 1.0, "may be used to endorse or promote products derived from this software"),
    ("gpl", "redistribute", 1.0, "this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e"),
    ("lgpl", "redistribute", 1.0, "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public licen[cs]e"),
    ("apache-2", "compliance", 1.0, "you may not use this file except in compliance with the licen[cs]e"),
    ("mpl-2", "mozilla", 1.0, "this source code form is subject to the terms of the mozilla public licen[cs]e"),
    ("unlicense", "unencumbered", 1.0, "this is free and unencumbered software released into the public domain"),
    ("cc0", "waived", 0.9, "has waived all copyright and related or neighboring rights"),
    ("zlib", "altered", 0.9, "altered source versions must be plainly marked as such"),
    ("boost", "boost", 1.0, "boost software licen[cs]e version 1 0"),
    ("public-domain", "domain", 0.7, "(?:released into|placed in|in|dedicated to) the public domain"),
    ("all-rights-reserved", "reserved", 0.6, "all rights reserved"),
    ("proprietary", "proprietary", 0.6, "proprietary and confidential"),
    ("proprietary", "unauthorized", 0.6, "unauthorized (?:copying|use|reproduction|distribution)"),
    ("non-commercial", "commercial", 0.5, "(?:for )?non ?commercial use only"),
    ("mit", "merchantability", 0.8, "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability"),
    ("mit", "sublicense", 0.8, "rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mit", "substantial", 0.8, "shall be included in all copies or substantial portions of the software"),
    ("mit-0", "restriction", 0.8, "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided"),
    ("isc", "appear", 0.8, "provided that the above copyright notice and this permission notice appear in all copies"),
    ("bsd", "redistributions", 0.9, "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "redistributions", 0.9, "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd-3-clause", "endorse", 0.9, "neither the name of [^ ]+(?: [^ ]+){0,6} nor the names of its contributors may be used to endorse"),
    ("bsd-4-clause", "advertising", 1.0, "all advertising materials mentioning features or use of this software must display the following acknowledg?ement"),
    ("bsd", "consequential", 0.6, "direct indirect incidental special exemplary or consequential damages"),
    ("apache-2", "apache", 1.0, "licensed under the apache licen[cs]e version 2 0 the licen[cs]e"),
    ("apache-2", "apache", 0.9, "www apache org licenses licen[cs]e 2 0"),
    ("apache-2", "governing", 0.8, "without warranties or conditions of any kind either express or implied see the licen[cs]e for the specific language governing permissions and limitations"),
    ("apache-2", "contributor", 0.9, "each contributor hereby grants to you a perpetual worldwide non ?exclusive no charge royalty free irrevocable (?:copyright|patent) licen[cs]e"),
    ("apache-1", "foundation", 0.9, "this product includes software developed by the apache software foundation"),
    ("gpl-2", "option", 1.0, "either version 2 of the licen[cs]e or at your option any later version"),
    ("gpl-3", "option", 1.0, "either version 3 of the licen[cs]e or at your option any later version"),
    ("gpl-2", "1991", 0.9, "gnu general public licen[cs]e version 2 june 1991"),
    ("gpl-3", "2007", 0.9, "gnu general public licen[cs]e version 3 29 june 2007"),
    ("gpl", "hope", 0.9, "this program is distributed in the hope that it will be useful but without any warranty"),
    ("gpl", "received", 0.8, "you should have received a copy of the gnu general public licen[cs]e"),
    ("gpl", "verbatim", 0.7, "everyone is permitted to copy and distribute verbatim copies of this licen[cs]e document but changing it is not allowed"),
    ("lgpl-2.1", "option", 1.0, "either version 2 1 of the licen[cs]e or at your option any later version"),
    ("lgpl", "received", 0.9, "you should have received a copy of the gnu lesser general public licen[cs]e"),
    ("agpl-3", "received", 0.9, "you should have received a copy of the gnu affero general public licen[cs]e"),
    ("agpl", "remotely", 0.8, "interacting with it remotely through a computer network"),
    ("gfdl", "invariant", 1.0, "with no invariant sections no front cover texts and no back cover texts"),
    ("mpl-2", "mpl", 0.9, "if a copy of the mpl was not distributed with this file"),
    ("mpl-1.1", "basis", 0.9, "software distributed under the licen[cs]e is distributed on an as is basis without warranty of any kind either express or implied"),
    ("epl-2", "accompanying", 1.0, "this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e(?: v)? ?2 0"),
    ("epl-1", "accompanying", 1.0, "this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e v1 0"),
    ("cddl", "development", 0.9, "the contents of this file are subject to the terms of the common development and distribution licen[cs]e"),
    ("artistic", "perl", 0.9, "under the same terms as perl itself"),
    ("boost", "boost", 0.9, "distributed under the boost software licen[cs]e"),
    ("boost", "obtaining", 0.9, "to any person or organization obtaining a copy of the software and accompanying documentation covered by this licen[cs]e"),
    ("zlib", "liable", 0.9, "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages"),
    ("zlib", "misrepresented", 0.9, "the origin of this software must not be misrepresented"),
    ("unlicense", "compile", 0.9, "anyone is free to copy modify publish use compile sell or distribute this software"),
    ("wtfpl", "fuck", 1.0, "do what the fuck you want to public licen[cs]e"),
    ("cc0", "dedicated", 0.9, "has dedicated the work to the public domain"),
    ("cc-by", "creativecommons", 0.9, "creativecommons org licenses by [1234] [05]"),
    ("cc-by-sa", "creativecommons", 0.9, "creativecommons org licenses by sa [1234] [05]"),
    ("cc-by-nd", "creativecommons", 0.9, "creativecommons org licenses by nd [1234] [05]"),
    ("cc-by-nc", "creativecommons", 0.9, "creativecommons org licenses by nc [1234] [05]"),
    ("cc-by-nc-sa", "creativecommons", 0.9, "creativecommons org licenses by nc sa [1234] [05]"),
    ("cc-by-nc-nd", "creativecommons", 0.9, "creativecommons org licenses by nc nd [1234] [05]"),
    ("cc0", "creativecommons", 0.9, "creativecommons org publicdomain zero 1 0"),
    ("openssl", "openssl", 0.9, "this product includes software developed by the openssl project"),
    ("php", "php", 0.9, "this product includes php software"),
    ("python", "hereby", 0.9, "psf hereby grants licensee a non ?exclusive royalty free world wide licen[cs]e"),
    ("postgresql", "fee", 0.8, "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("ofl", "font", 0.9, "this font software is licensed under the sil open font licen[cs]e"),
    ("ncsa", "illinois", 0.9, "neither the names of [^ ]+(?: [^ ]+){0,12} university of illinois"),
    ("w3c", "w3c", 0.8, "w3c software (?:and document )?notice"),
    ("sspl", "functionality", 0.8, "if you make the functionality of the program or a modified version available to third parties as a service"),
    ("busl", "hereby", 0.8, "licensor hereby grants you the right to copy modify create derivative works redistribute and make non ?production use of the licensed work"),
    ("copyright-notice", "copyright", 0.3, "copyright (?:c )?(?:19|20)[0-9][0-9]"),
)
_NOT_WORD = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _apart(pattern: str) -> str:
    """Words between two spaces each. ` ?` stands for one word or two."""
    return " " + pattern.replace(" ?", "\0").replace(" ", "  ").replace("\0", "(?:  )?") + " "


def rules() -> list[tuple[int, str, str, float, str, str]]:
    """priority, label, keyword, confidence, pattern, hint; in order of priority."""
    out = [(p, label, word, sure, form.replace("{}", name), hint) for p, sure, hint, form in FORMS for label, word, name in NAMES]
    # the names that hold their own proof need no form around them
    out += [(4, label, word, 0.7, name, word) for label, word, name in NAMES if " " in name.replace("(?: ", "") and word not in ("mit", "software", "common", "side", "business", "elastic")]
    out += [(1, label, word, sure, text, word) for label, word, sure, text in NOTICES]
    return [(p, label, word, sure, _apart(text), hint) for p, label, word, sure, text, hint in sorted(out, key=lambda r: r[0])]


def _spans(norm: Column, rule: Column) -> Column:
    """Intervals (from, negative end for the order, priority, label, confidence) of a rule's matches, in order."""
    found, parts = F.regexp_extract_all(norm, rule["pattern"], F.lit(0)), F.split(norm, rule["pattern"], -1)
    span = "array<struct<a:int,minus_b:int,p:int,label:string,sure:double>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(span).alias("out"))

    def step(s: Column, i: Column) -> Column:
        a = s["at"] + F.length(parts[i])
        b = a + F.length(found[i])
        new = F.struct(a.alias("a"), (-b).alias("minus_b"), rule["p"].alias("p"), rule["label"].alias("label"), rule["sure"].alias("sure"))
        return F.struct(b.alias("at"), F.concat(s["out"], F.array(new)).alias("out"))

    return F.when(F.size(found) > 0, F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), start, step)["out"]).otherwise(F.array().cast(span))


def _lowered(text: Column) -> Column:
    """A-Z become a-z. lower() is many times as fast as translate(), and what it does to other letters matters to no rule,
    but for the two whose small form holds an ASCII letter."""
    return F.when(F.contains(text, F.lit("\u0130")) | F.contains(text, F.lit("\u212a")), F.translate(text, _UPPER, _LOWER)).otherwise(F.lower(text))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans for each row of docs."""
    table = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(label).alias("label"), F.lit(word).alias("word"), F.lit(hint).alias("hint"), F.lit(sure).alias("sure"), F.lit(text).alias("pattern")) for p, label, word, sure, text, hint in rules()])
    keywords = sorted({w for r in rules() for w in (r[2], r[5])})
    t, norm = F.col("__text"), F.col("__norm")
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__text"))
    rows = rows.withColumn("__words", F.array_remove(F.split(t, _NOT_WORD), ""))
    joined = F.concat(F.lit(" "), F.array_join("__words", "  "), F.lit(" "))
    rows = rows.select("doc_id", F.size("__words").cast("long").alias("n_words"), _lowered(joined).alias("__norm"))

    places, firsts, lasts, labels = [], [], [], []
    for phrase, label in BASE:
        wide = _apart(phrase)
        n = ((F.length(norm) - F.length(F.replace(norm, F.lit(wide), F.lit("")))) / len(wide)).cast("long")
        before = lambda at, of: F.length(F.regexp_replace(F.substring(of, 1, at - 1), "[^ ]+", "")) / 2  # noqa: E731  words before a place
        there = F.instr(norm, wide)
        back = F.locate(wide[::-1], F.reverse(norm))
        places.append(n)
        firsts.append(F.when(there > 0, before(there, norm).cast("long")))
        lasts.append(F.when(there > 0, F.col("n_words") - len(phrase.split()) - before(back, F.reverse(norm)).cast("long")))
        labels.append(F.when(there > 0, F.lit(label)))
    present = F.array_compact(F.array(*[F.when(F.contains(norm, F.lit(k)), F.lit(k)) for k in keywords]))
    rows = rows.select(
        "doc_id", "n_words", "__norm",
        sum(places[1:], places[0]).alias("n_base"), F.least(*firsts).alias("first_word"), F.greatest(*lasts).alias("last_word"),
        F.array_sort(F.array_compact(F.array(*labels))).alias("__base"),
        present.alias("__present"),
    )
    rows = rows.withColumn("__rules", F.when(F.size("__present") > 0, F.filter(table, lambda r: F.array_contains("__present", r["word"]) & F.array_contains("__present", r["hint"]))))
    found = F.coalesce(F.flatten(F.transform("__rules", lambda r: _spans(norm, r))), F.array().cast("array<struct<a:int,minus_b:int,p:int,label:string,sure:double>>"))
    rows = rows.withColumn("__found", F.sort_array(found)).drop("__rules", "__present")
    empty = F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<a:int,minus_b:int,p:int,label:string,sure:double>>").alias("out"))
    stays = F.aggregate(
        "__found", empty,
        lambda s, x: F.struct(F.greatest(s["end"], -x["minus_b"]).alias("end"), F.when(-x["minus_b"] > s["end"], F.concat(s["out"], F.array(x))).otherwise(s["out"]).alias("out")),
    )["out"]
    rows = rows.withColumn("__stays", stays)
    base_sure = F.when(F.size("__base") > 0, F.lit(0.95)).otherwise(F.lit(0.0))
    return rows.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("__base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("__base", F.transform("__stays", lambda x: x["label"]))), ",").alias("labels"),
        F.greatest(base_sure, F.coalesce(F.array_max(F.transform("__stays", lambda x: x["sure"])), F.lit(0.0))).alias("score"),
    )


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: base places and labels, and the labels of the rules, for each document."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql() -> str:
    listed = ",\n".join(f"({p}, '{label}', '{word}', {sure}::DOUBLE, '{text}')" for p, label, word, sure, text, _ in rules())
    phrases = ", ".join(f"('{_apart(phrase)}', '{label}')" for phrase, label in BASE)
    return f"""
WITH rule(p, label, word, sure, pattern) AS (VALUES {listed}),
phrase(wide, label) AS (VALUES {phrases}),
cut AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
norm AS (SELECT r, ' ' || array_to_string(w, '  ') || ' ' AS s FROM cut WHERE len(w) > 0),
part AS (SELECT r, label, string_split(s, wide) AS x FROM norm JOIN phrase ON contains(s, wide)),
place AS (SELECT r, label, (list_sum(list_transform(x[1 : i], lambda y: length(y) - length(replace(y, ' ', '')))) + (i - 1) * (length(wide) - length(replace(wide, ' ', '')))) // 2 AS spot
    FROM (SELECT r, label, x, wide, unnest(generate_series(1, len(x) - 1)) AS i FROM part JOIN phrase USING (label))),
base AS (SELECT r, count(*) AS n, min(spot) AS f, max(spot) AS l, array_to_string(list_sort(list(DISTINCT label)), ',') AS labels FROM place GROUP BY r),
hit AS (SELECT r, rule.*, regexp_extract_all(s, pattern) AS m, string_split_regex(s, pattern) AS x FROM norm JOIN rule ON contains(s, word) AND regexp_matches(s, pattern)),
one AS (SELECT r, p, label, sure, coalesce(list_sum(list_transform(x[1 : i], lambda y: length(y))), 0) + coalesce(list_sum(list_transform(m[1 : i - 1], lambda y: length(y))), 0) AS a, length(m[i]) AS n
    FROM (SELECT *, unnest(generate_series(1, len(m))) AS i FROM hit)),
span AS (SELECT DISTINCT r, p, label, sure, a, a + n AS b FROM one),
stay AS (SELECT * FROM span d WHERE NOT EXISTS (SELECT 1 FROM span e WHERE e.r = d.r AND e.a <= d.a AND e.b >= d.b
    AND (e.a < d.a OR e.b > d.b OR (e.p, e.label, e.sure) < (d.p, d.label, d.sure)))),
labels AS (SELECT r, label FROM stay UNION SELECT r, label FROM place),
listed AS (SELECT r, array_to_string(list_sort(list(label)), ',') AS labels FROM labels GROUP BY r),
sure AS (SELECT r, max(sure) AS s FROM (SELECT r, sure FROM stay UNION ALL SELECT r, 0.95 FROM place) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(base.n, 0)::BIGINT AS n_base, base.f::BIGINT AS first_word, base.l::BIGINT AS last_word,
    coalesce(base.labels, '') AS base_labels, coalesce(listed.labels, '') AS labels, coalesce(sure.s, 0)::DOUBLE AS score
FROM cut LEFT JOIN base USING (r) LEFT JOIN listed USING (r) LEFT JOIN sure USING (r)
"""


SQL = _sql()
