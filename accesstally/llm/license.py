"""License scans over a positional index of rare words.

Each template has a key phrase that must stand in a file: notices have a mandatory part of their text,
base phrases are their own key. The index holds, for each template, the places of the two words of its
key with the highest inverse document frequency over all documents. A file that has the rarest word of
any key looks its words up there; every hit says where the template would start, starts that all of a
template's words agree on are the intersection, and the whole key is then compared word by word. As the
key is mandatory, looking up its rarest words alone loses no file. Base places and notices are found alike.

Documents are read twice, once to count the templates' words and once to scan; the scan works within
each row and shuffles nothing. The templates are a fixed list, so the index in the plan has a fixed size.

Cases: null or empty text has no words, no labels and score 0. Places overlap freely and all count.
Rows are judged one by one, also where numbers repeat or are null; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from accesstally.llm.text import words

#: The phrases of the base search and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Label, notice and the phrase in it that must be there. Words as the scan sees them.
TEMPLATES = [
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("gpl-2.0", "this work is licensed under the gnu general public license version 2", "gnu general public license version 2"),
    ("gpl-any", "under the terms of the gnu general public license as published by the free software foundation", "gnu general public license as published"),
    ("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license", "gnu affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("mit-notice", "released under the mit license", "under the mit license"),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "hereby granted free of charge"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source"),
    ("bsd-clauses", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", "redistributions of source code must retain"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", "copy modify and or distribute this software"),
    ("mpl-2.0", "subject to the terms of the mozilla public license version 2 0", "mozilla public license version 2 0"),
    ("epl", "made available under the terms of the eclipse public license", "eclipse public license"),
    ("apache-2.0-header", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied", "www apache org licenses license 2 0"),
    ("gpl-header", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("mpl-2.0-header", "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0", "mozilla org mpl 2 0"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software", "in no event will the authors be held liable"),
    ("no-warranty", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement", "software is provided as is without warranty of any kind"),
    ("bsl-1.0", "distributed under the boost software license version 1 0", "boost software license version 1 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means", "free and unencumbered software"),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    ("cc-by-nd-4.0", "licensed under cc by nd 4 0", "cc by nd 4 0"),
    ("cc0-1.0", "released under the cc0 1 0 universal public domain dedication", "cc0 1 0 universal"),
    ("cc-by-name", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
]

#: Words of a key that are looked up.
RARE = 2


def entries() -> list[tuple[str, list[str], list[str], int, bool]]:
    """What the index knows: label, notice, key, the key's place in the notice, whether it is a base phrase."""
    known = [(label, notice, key, False) for label, notice, key in TEMPLATES]
    known += [(label, phrase, phrase, True) for phrase, label in BASE.items()]
    start = lambda notice, key: len(notice[: f" {notice} ".index(f" {key} ")].split())
    return [(label, notice.split(), key.split(), start(notice, key), base) for label, notice, key, base in known]


def word_counts(documents: DataFrame, text: str = "text") -> dict[str, int]:
    """In how many documents each word of a key occurs; at most as many rows as the keys have words."""
    vocabulary = sorted({w for _, _, key, _, _ in entries() for w in key})
    own = F.array_intersect(words(F.col(text)), F.array(*map(F.lit, vocabulary)))
    rows = documents.select(F.explode(own).alias("word")).groupBy("word").count().collect()
    return dict.fromkeys(vocabulary, 0) | {r["word"]: r["count"] for r in rows}


def index(counts: dict[str, int]) -> tuple[dict[str, list[tuple[int, int]]], list[int], list[str]]:
    """Postings (template, place) by word, how many of them each template has, and the rarest words of the keys.

    The fewer documents hold a word, the higher its inverse document frequency.
    """
    postings: dict[str, list[tuple[int, int]]] = {}
    needed, leads = [], set()
    for t, (_, _, key, at, _) in enumerate(entries()):
        rarest = sorted(set(key), key=lambda w: (counts[w], w))[:RARE]
        leads.add(rarest[0])
        own = [(w, at + i) for i, w in enumerate(key) if w in rarest]
        needed.append(len(own))
        for w, place in own:
            postings.setdefault(w, []).append((t, place))
    return postings, needed, sorted(leads)


def _strings(values: list[str]) -> Column:
    return F.array(*map(F.lit, values))


def scan(documents: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """For every row: doc_id, n_words, the base places [(label, start)] and the notices [(label, start, share)].

    ``start`` is the first word of the template's alignment; a notice's may lie before the text's first
    word. ``share`` is the part of the notice's words that stand where the alignment puts them.
    """
    known = entries()
    postings, needed, leads = index(word_counts(documents, text))
    of_word = F.create_map(*[
        part for word, places in sorted(postings.items())
        for part in (F.lit(word), F.array(*[F.struct(F.lit(t).alias("t"), F.lit(place).alias("place")) for t, place in places]))
    ])
    each = lambda values, t: F.element_at(F.array(*values), t + 1)
    label = lambda t: each([F.lit(e[0]) for e in known], t)
    notice = lambda t: each([_strings(e[1]) for e in known], t)
    key = lambda t: each([_strings(e[2]) for e in known], t)
    key_at = lambda t: each([F.lit(e[3]) for e in known], t)
    is_base = lambda t: each([F.lit(e[4]) for e in known], t)
    postings_of = lambda t: each([F.lit(n) for n in needed], t)

    rows = documents.select(F.col(doc_id).alias("doc_id"), words(F.col(text)).alias("w"))
    hits = F.filter(F.transform("w", lambda x, i: F.struct(i.alias("at"), x.alias("word"))), lambda s: s["word"].isin(sorted(postings)))
    starts = F.transform(hits, lambda h: F.transform(of_word[h["word"]], lambda p: F.struct(p["t"].alias("t"), (h["at"] - p["place"]).alias("start"))))
    # in order, a start that all of a template's words agree on stands as often as the template has postings
    starts = F.array_sort(F.flatten(starts))
    none = F.array().cast("array<struct<t:int,start:int>>")
    rows = rows.withColumn("starts", F.when(F.arrays_overlap("w", _strings(leads)), starts).otherwise(none))
    agreed = F.filter("starts", lambda s, i: ((i == 0) | (F.get("starts", i - 1) != s)) & (F.get("starts", i + postings_of(s["t"]) - 1) == s))
    here = lambda s: s["start"] + key_at(s["t"])
    found = F.filter(agreed, lambda s: (here(s) >= 0) & (F.slice("w", F.greatest(here(s), F.lit(0)) + 1, F.size(key(s["t"]))) == key(s["t"])))
    rows = rows.select("doc_id", "w", found.alias("found"))

    stands = lambda s: F.transform(notice(s["t"]), lambda x, i: (F.get("w", s["start"] + i) == x))
    share = lambda s: F.size(F.filter(stands(s), lambda x: x)) / F.size(notice(s["t"]))
    base = F.transform(F.filter("found", lambda s: is_base(s["t"])), lambda s: F.struct(label(s["t"]).alias("label"), s["start"].alias("start")))
    notices = F.transform(
        F.filter("found", lambda s: ~is_base(s["t"])),
        lambda s: F.struct(label(s["t"]).alias("label"), s["start"].alias("start"), share(s).alias("share")),
    )
    return rows.select("doc_id", F.size("w").alias("n_words"), base.alias("base"), notices.alias("notices"))


def report(found: DataFrame) -> DataFrame:
    starts = F.transform("base", lambda s: s["start"])
    base_labels = F.array_distinct(F.transform("base", lambda s: s["label"]))
    own = F.transform("notices", lambda s: s["label"])
    share = F.coalesce(F.array_max(F.transform("notices", lambda s: s["share"])), F.lit(0.0))
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base_labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base_labels, own)), ",").alias("labels"),
        F.round(F.greatest(share, F.when(F.size("base") > 0, 0.5).otherwise(0.0)), 6).alias("score"),
    )


def op8_license(spark, sf_dir):
    return report(scan(spark.read.parquet(f"{sf_dir}/documents.parquet")))


def _values() -> str:
    rows = [f"({t}, '{label}', '{notice}', '{key}')" for t, (label, notice, key) in enumerate(TEMPLATES)]
    return ", ".join(rows)


#: Places of whole keys in texts; which words were looked up cannot change them.
OP8_SQL = rf"""
WITH t(t, label, notice, k) AS (VALUES {_values()}),
tw AS (SELECT t, label, string_split(notice, ' ') AS nw, string_split(k, ' ') AS kw,
         len(string_split(trim(notice[: strpos(' ' || notice || ' ', ' ' || k || ' ') - 1]), ' '))
           - (strpos(' ' || notice || ' ', ' ' || k || ' ') = 1)::INT AS key_at FROM t),
b(phrase, label) AS (VALUES {", ".join(f"('{p}', '{label}')" for p, label in BASE.items())}),
d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
p AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d),
bh AS (SELECT r, label, i - 1 AS place FROM p JOIN b ON w[i] = string_split(phrase, ' ')[1]
       AND array_to_string(w[i : i + len(string_split(phrase, ' ')) - 1], ' ') = phrase),
bg AS (SELECT r, count(*) AS n, min(place) AS a, max(place) AS z FROM bh GROUP BY r),
nh AS (SELECT r, label, list_sum([(coalesce(w[i - key_at + j - 1], '') = nw[j] AND i - key_at + j - 1 > 0)::INT
                                  FOR j IN range(1, len(nw) + 1)]) / len(nw) AS share
       FROM p JOIN tw ON w[i] = kw[1] AND w[i : i + len(kw) - 1] = kw),
ng AS (SELECT r, max(share) AS share FROM nh GROUP BY r),
bl AS (SELECT r, string_agg(label, ',' ORDER BY label) AS s FROM (SELECT DISTINCT r, label FROM bh) GROUP BY r),
al AS (SELECT r, string_agg(label, ',' ORDER BY label) AS s
       FROM (SELECT r, label FROM bh UNION SELECT r, label FROM nh) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, a::BIGINT AS first_word,
  z::BIGINT AS last_word, coalesce(bl.s, '') AS base_labels, coalesce(al.s, '') AS labels,
  round(greatest(coalesce(share, 0)::DOUBLE, CASE WHEN n > 0 THEN 0.5 ELSE 0 END)::DOUBLE, 6) AS score
FROM d LEFT JOIN bg USING (r) LEFT JOIN ng USING (r) LEFT JOIN bl USING (r) LEFT JOIN al USING (r)
"""
