"""License scan by diagonal voting.

Every text's words give rolling hashes of ``GRAM`` words. All of them are joined by Spark with the places
where the templates have them (a table of the templates' size, which is a parameter and broadcast). A
match of text place p and template place q votes for the diagonal p - q. Votes are summed by text, template
and diagonal, diagonals that lie at most ``SLACK`` apart are merged (words put in or left out), and a merged
span counts if it is no longer than the template allows and holds enough of the template's hashes. Words at
a match are compared as text, so that equal hashes alone never count.

A base phrase is a template too, of which only a single full diagonal counts: its words stand there
consecutively.

Defined results: null and empty texts have no words, no places, empty labels and score 0. Repeated ids are
separate rows; rows that repeat id and words get the same result each. A null id is kept. Columns other
than the id and the text are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatloom.llm.common import flat_bytes, gram_hashes, hashed_words, ragged, table, text_chunks

GRAM = 3
SLACK = 3
#: Share of a template's hashes that a span must hold, and how much longer than the template it may be.
COVER = 0.6
STRETCH = 1.3

BASE_PHRASES = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]

#: Public license notices.
TEMPLATES = [
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        " associated documentation files (the Software), to deal in the Software without restriction,"
        " including without limitation the rights to use, copy, modify, merge, publish, distribute,"
        " sublicense, and/or sell copies of the Software",
    ),
    (
        "apache-2",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in"
        " compliance with the License. You may obtain a copy of the License at",
    ),
    ("cc-by-nc", "licensed under a Creative Commons Attribution NonCommercial 4.0 International License"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted"
        " provided that the following conditions are met",
    ),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
        " General Public License as published by the Free Software Foundation",
    ),
]

#: Joined like a hash, once per text, so that texts without a match stay.
MARK = 0


def template_grams(texts: list[str]) -> list[tuple[int, int, int, str]]:
    """(template, place, hash, words) of every hash of the templates."""
    rows = []
    for k, text in enumerate(texts):
        data = np.frombuffer(text.encode(), np.uint8)
        codes, starts, ends, _ = hashed_words(data, np.array([0, len(data)]))
        words = [data[a:b].tobytes().decode().lower() for a, b in zip(starts, ends)]
        if len(words) < GRAM:
            raise ValueError(f"a template needs {GRAM} words: {text}")
        for at, code in enumerate(gram_hashes(codes, GRAM).view(np.int64).tolist()):
            rows.append((k, at, code, " ".join(words[at : at + GRAM])))
    return rows


def hashed(docs: DataFrame, known: list[int], id_col: str, text_col: str) -> DataFrame:
    """Per row: id, a hash of its text, its number of words, all rolling hashes (a mark first), and the words
    at the places whose hash is one of ``known``."""
    # Rows are named by id and text, since ids may be null or repeat.
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("whole"))
    kind = given.schema["id"].dataType.simpleString()
    wanted = np.unique(np.array(known, np.int64))

    def work(batches):
        for part in text_chunks(batches, "text"):
            data, offsets = flat_bytes(part.column("text"))
            codes, starts, ends, bounds = hashed_words(data, offsets)
            grams = gram_hashes(codes, GRAM).view(np.int64)
            counts = np.diff(bounds)
            each = np.maximum(counts - GRAM + 1, 0)
            own = ragged(bounds[:-1], each)
            row = np.repeat(np.arange(len(counts)), each)
            found = np.flatnonzero(np.isin(grams[own], wanted))
            words = [
                " ".join(data[starts[w] : ends[w]].tobytes().decode("utf-8", "replace").lower() for w in range(at, at + GRAM))
                for at in own[found].tolist()
            ]
            marked = np.insert(grams[own], np.cumsum(each) - each, MARK)
            lists = lambda sizes, values: pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), values
            )
            hits = np.bincount(row[found], minlength=len(counts))
            columns = [
                part.column("id"),
                part.column("whole"),
                pa.array(counts, pa.int64()),
                lists(each + 1, pa.array(marked)),
                lists(hits, pa.array((own - bounds[row])[found] + 1, pa.int32())),
                lists(hits, pa.array(words, pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "whole", "n_words", "grams", "hit_at", "hit_words"])

    schema = f"id {kind}, whole long, n_words long, grams array<long>, hit_at array<int>, hit_words array<string>"
    return given.mapInArrow(work, schema)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base=None, templates=None) -> DataFrame:
    """Per row: ``id, n_words``, ``spans`` (label, base, start, end, cover: all that were verified), and what
    is summed from them."""
    base, templates = BASE_PHRASES if base is None else base, TEMPLATES if templates is None else templates
    grams = template_grams([text for _, text in [*base, *templates]])
    spark = docs.sparkSession
    held = spark.createDataFrame([*grams, (-1, 0, MARK, "")], "template int, place int, gram long, words string")
    sizes = {}
    for k, *_ in grams:
        sizes[k] = sizes.get(k, 0) + 1
    info = [(k, label, k < len(base), sizes[k]) for k, (label, _) in enumerate([*base, *templates])]
    info = spark.createDataFrame(info, "template int, label string, base boolean, size int")

    rows = hashed(docs, [g for *_, g, _ in grams], id_col, text_col)
    placed = rows.select("id", "whole", "n_words", "hit_at", "hit_words", F.posexplode("grams").alias("at", "gram"))
    # The templates are a parameter of fixed size, a few hundred rows.
    joined = placed.join(F.broadcast(held), "gram")
    shown = F.element_at(F.map_from_arrays("hit_at", "hit_words"), F.col("at"))
    key = ["id", "whole", "n_words"]
    marks = F.col("template") < 0
    joined = joined.where((F.col("at") == 0) & marks | ~marks & (shown == F.col("words")))
    diagonal = F.when(marks, 0).otherwise(F.col("at") - 1 - F.col("place"))
    votes = joined.select(*key, "template", "place", diagonal.alias("diagonal"))
    votes = votes.groupBy(*key, "template", "diagonal").agg(
        F.collect_set("place").alias("places"), F.count(F.when(marks, 1)).alias("copies")
    )
    votes = votes.join(F.broadcast(info), "template", "left")
    by_template = Window.partitionBy(*key, "template").orderBy("diagonal")
    # Base phrases stand on one diagonal each, others may shift.
    new = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(by_template) > F.when(F.col("base"), 0).otherwise(SLACK), F.lit(True))
    votes = votes.withColumn("run", F.sum(new.cast("int")).over(by_template))
    spans = votes.groupBy(*key, "template", "label", "base", "size", "run").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("hits"),
        F.min(F.col("diagonal") + F.array_min("places")).cast("long").alias("start"),
        F.max(F.col("diagonal") + F.array_max("places") + GRAM).cast("long").alias("end"),
        F.sum("copies").alias("copies"),
    )
    cover = F.col("hits") / F.col("size")
    long_enough = F.col("end") - F.col("start") <= STRETCH * (F.col("size") + GRAM - 1)
    right = F.when(F.col("base"), cover == 1).otherwise((cover >= COVER) & long_enough)
    span = F.when(right, F.struct("label", "base", "start", "end", cover.alias("cover")))
    found = spans.groupBy(*key).agg(F.collect_list(span).alias("spans"), F.max("copies").alias("copies"))
    base_spans = F.filter("spans", lambda s: s["base"])
    joined_labels = lambda some: F.array_join(F.array_sort(F.array_distinct(F.transform(some, lambda s: s["label"]))), ",")
    # Rows that repeat id and text were counted, and come back as often.
    again = found.select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy"))
    return again.select(
        "id",
        "n_words",
        "spans",
        F.size(base_spans).cast("long").alias("n_base"),
        F.array_min(F.transform(base_spans, lambda s: s["start"])).alias("first_word"),
        F.array_max(F.transform(base_spans, lambda s: s["start"])).alias("last_word"),
        joined_labels(base_spans).alias("base_labels"),
        joined_labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["cover"])), F.lit(0.0)).alias("score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its base places and labels, the labels of all templates, and the best cover."""
    found = scan(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id").drop("spans")
