"""License scans by diagonal voting, with DataFrame operations only.

Rolling word k-grams of a text (k is 2 for short templates, 4 for others) are joined by hash to the positions of the
same k-grams in license templates.  A hit's diagonal is its place in the text less its place in the template; hits on
one diagonal vote for the template standing there.  A diagonal with a vote from every k-gram is the whole template,
word for word.  What is left of long templates is merged with its neighbouring diagonals (a word put in or left out
moves the rest to the next one) and verified: enough of the template's words must stand there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What separates words, in lower-cased text.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Base phrases: fixed values.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
#: Texts of well-known licenses and notices: fixed values, lower-cased, without punctuation.
_WARRANTY = (
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of "
    "merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable "
    "for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection "
    "with the software or the use or other dealings in the software"
)
PASSAGES = [
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
        "the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
        "distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject "
        "to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the software " + _WARRANTY,
        "mit",
    ),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may "
        "obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing "
        "software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express "
        "or implied see the license for the specific language governing permissions and limitations under the license",
        "apache",
    ),
    ("licensed under the apache license version 2 0", "apache"),
    ("you may not use this file except in compliance with the license", "apache"),
    (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
        "published by the free software foundation either version 3 of the license or at your option any later version this program is "
        "distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or "
        "fitness for a particular purpose see the gnu general public license for more details",
        "gpl",
    ),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions "
        "are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the "
        "documentation and or other materials provided with the distribution",
        "bsd",
    ),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that "
        "the above copyright notice and this permission notice appear in all copies",
        "isc",
    ),
    (
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this "
        "file you can obtain one at http mozilla org mpl 2 0",
        "mpl",
    ),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    (
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or "
        "distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
        "unlicense",
    ),
    ("all rights reserved", "all-rights-reserved"),
]
#: Words of a k-gram in long templates and in short ones, which have at most SHORT words.
LONG_GRAM, SHORT_GRAM, SHORT = 4, 2, 5
#: Diagonals this near are merged; least share of a template's words.
NEAR, SHARE = 3, 0.6
#: Places of a template in one mask.
BITS = 60


def templates(spark: SparkSession) -> DataFrame:
    """(template, label, is_base, size, k, n_grams, at, and the words of a k-gram) of all phrases and passages; fixed in size."""
    rows = []
    for t, (text, label) in enumerate(PHRASES + PASSAGES):
        words = text.split()
        k = SHORT_GRAM if len(words) <= SHORT else LONG_GRAM
        n = len(words) - k + 1
        rows += [(t, label, t < len(PHRASES), len(words), k, n, i, *(words[i : i + k] + [None] * (LONG_GRAM - k))) for i in range(n)]
    fields = ", ".join(f"t_{i} string" for i in range(LONG_GRAM))
    return spark.createDataFrame(rows, f"template int, label string, is_base boolean, size int, k int, n_grams int, at int, {fields}")


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of each row.

    n_base, first_word, last_word: number and first and last place of whole base phrases (null: none).  labels:
    the base phrases' and the verified passages', sorted; empty where there is none.  score: the largest share
    of a verified template's words.  Null and empty texts have no words.  Repeated rows get a row each; other
    columns are not read; an empty table gives no rows.
    """
    words = F.array_remove(F.split(F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), UPPER, LOWER), SEPARATORS), "")
    listed = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), words.alias("words"))
    shifted = [F.slice("words", i + 1, (1 << 31) - 1).alias(f"w_{i}") for i in range(LONG_GRAM)]
    grams = listed.select("doc_id", "row", F.posexplode_outer(F.arrays_zip(*shifted)).alias("p", "gram"))
    grams = grams.select("doc_id", "row", "p", *[F.col(f"gram.w_{i}").alias(f"w_{i}") for i in range(LONG_GRAM)])
    known = templates(docs.sparkSession).withColumn("t_hash", F.xxhash64("t_0", "t_1"))
    same = F.xxhash64("w_0", "w_1") == F.col("t_hash")
    for i in range(LONG_GRAM):
        same &= (F.col("k") <= i) | (F.col(f"w_{i}") == F.col(f"t_{i}"))
    hits = grams.join(F.broadcast(known), same, "left").withColumn("diagonal", (F.col("p") - F.col("at")).cast("long"))
    template = ["doc_id", "row", "template", "label", "is_base", "size", "k", "n_grams"]
    longest = max(len(text.split()) for text, _ in PASSAGES)
    bits = [F.bit_or(F.when(F.floor(F.col("at") / BITS) == i, F.expr(f"shiftleft(1L, at % {BITS})"))).alias(f"m_{i}") for i in range(longest // BITS + 1)]
    votes = hits.groupBy(*template, "diagonal").agg(F.count("at").alias("votes"), *bits, F.min("p").alias("low"), F.max("p").alias("high"))
    masks = F.array(*[F.coalesce(f"m_{i}", F.lit(0).cast("long")) for i in range(len(bits))])
    voted = lambda i: F.getbit(masks[F.floor(i / BITS).cast("int")], (i % BITS).cast("int")) == 1
    whole = F.col("votes") == F.col("n_grams")
    near = Window.partitionBy("row", "template", "whole").orderBy("diagonal").rangeBetween(-NEAR, NEAR)
    around = F.flatten(F.collect_list("ats").over(near))
    covered = F.size(F.array_distinct(F.flatten(F.transform(around, lambda a: F.sequence(a, a + F.col("k") - 1)))))
    spans = votes.withColumn("whole", F.coalesce(whole, F.lit(False)))
    partial = ~F.col("whole") & F.col("template").isNotNull() & ~F.col("is_base")
    spans = spans.withColumn("ats", F.when(partial, F.filter(F.sequence(F.lit(0), F.col("n_grams") - 1), voted)))
    spans = spans.withColumn("share", F.when(F.col("whole"), 1.0).when(~F.col("is_base"), covered / F.col("size")))
    base = F.col("is_base") & F.col("whole")
    found = base | (~F.col("is_base") & (F.col("share") >= SHARE))
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return (
        spans.groupBy("doc_id", "row")
        .agg(
            F.coalesce(F.max("high") + 1, F.lit(0)).cast("long").alias("n_words"),
            F.count(F.when(base, 1)).alias("n_base"),
            F.min(F.when(base, F.col("low"))).cast("long").alias("first_word"),
            F.max(F.when(base, F.col("low"))).cast("long").alias("last_word"),
            joined(F.when(base, F.col("label"))).alias("base_labels"),
            joined(F.when(found, F.col("label"))).alias("labels"),
            F.coalesce(F.max(F.when(found, F.col("share"))), F.lit(0.0)).alias("score"),
        )
        .drop("row")
    )
