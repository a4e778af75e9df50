"""Licence notices in files, found by a positional index of their rarest words.

Templates are short notices. How rare each template word is comes from all documents. A template is
looked up by its rarest words only: such a word in a file, together with its position in the template,
says where the notice would begin. A template of n words of which m must match has at most n - m words out of place, so
one of any n - m + 1 positions is right wherever it stands: that many of the rarest are looked up, and no notice
is lost. The words at each place found are compared with the template, and its mandatory key phrases must stand in them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.text import alphanumeric_words, small_side
from plumbline.session import local_frame, materialise


@dataclass(frozen=True)
class Template:
    """A notice in lower-case words. ``coverage`` is the least share of its words that must match."""

    label: str
    text: str
    key_phrases: tuple[str, ...]
    coverage: float = 0.7

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def lookups(self) -> int:
        """Positions of which one must be right."""
        n = len(self.words)
        least = next(same for same in range(n + 1) if same >= self.coverage * n)
        return n - max(least, 1) + 1


def phrase(label: str, text: str) -> Template:
    """A phrase that must occur as it is, wherever it occurs."""
    return Template(label, text, (text,), 1.0)


#: Phrases that are counted at every place.
BASE = (
    phrase("cc-by", "cc by"),
    phrase("gpl", "general public license"),
    phrase("reserved", "all rights reserved"),
)

#: Openings of well-known notices.
NOTICES = (
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
             "provided that the following conditions are met", ("source and binary forms",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license",
             ("creative commons attribution noncommercial",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license",
             ("creative commons attribution sharealike",)),
    Template("cc0", "to the extent possible under law the author has waived all copyright and related or "
             "neighboring rights to this work", ("waived all copyright",)),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", ("gnu general public license",)),
    Template("lgpl", "under the terms of the gnu lesser general public license", ("lesser general public license",)),
    Template("agpl", "under the terms of the gnu affero general public license", ("affero general public license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software "
             "and associated documentation files", ("permission is hereby granted",)),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0",
             ("mozilla public license",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             ("free and unencumbered software",)),
    Template("proprietary", "unauthorized copying of this file via any medium is strictly prohibited",
             ("strictly prohibited",)),
)


def _template_words(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """(template, place, word): the postings; a fixed number of rows."""
    rows = [
        {"template": number, "place": place, "word": word}
        for number, template in enumerate(templates) for place, word in enumerate(template.words)
    ]
    return local_frame(spark, rows, "template int, place int, word string")


def word_frequencies(documents: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(word, n_documents) of the vocabulary's words over all documents."""
    known = F.array(*map(F.lit, vocabulary))
    found = documents.select(F.explode_outer(F.array_intersect(alphanumeric_words("text"), known)).alias("word"))
    return found.where("word IS NOT NULL").groupBy("word").agg(F.count("*").alias("n_documents"))


def _lookups(postings: DataFrame, frequencies: DataFrame, templates: tuple[Template, ...]) -> DataFrame:
    """(template, place, word) of each template's rarest positions, of equally rare words the first in order.

    Words that no document has cannot be right, so only others count.
    """
    counts = local_frame(
        postings.sparkSession, [{"template": number, "lookups": t.lookups} for number, t in enumerate(templates)],
        "template int, lookups int",
    )
    ranked = postings.join(frequencies, "word").groupBy("template").agg(
        F.sort_array(F.collect_list(F.struct("n_documents", "word", "place"))).alias("words")
    )
    rarest = ranked.join(counts, "template").select(
        "template", F.explode(F.slice("words", F.lit(1), F.col("lookups"))).alias("rare")
    )
    return rarest.select("template", "rare.word", "rare.place")


def _details(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """Of each template what verification needs."""
    rows = [
        {"template": number, "label": t.label, "template_words": t.words, "phrases": list(t.key_phrases),
         "coverage": t.coverage}
        for number, t in enumerate(templates)
    ]
    return local_frame(
        spark, rows, "template int, label string, template_words array<string>, phrases array<string>, coverage double")


def _words(text: Column) -> Column:
    return F.concat(F.lit(" "), F.concat_ws(" ", text), F.lit(" "))


def matches(documents: DataFrame, templates: tuple[Template, ...]) -> DataFrame:
    """(id, text_hash, template, label, start, n, coverage) of every verified place of a template."""
    spark = documents.sparkSession
    postings = _template_words(spark, templates)
    vocabulary = sorted({word for template in templates for word in template.words})
    frequencies = materialise(word_frequencies(documents, vocabulary), "licence-words")
    lookups = materialise(_lookups(postings, frequencies, templates), "licence-index")
    details = _details(spark, templates)

    # The index has a row per looked-up position at most; small_side counts it before it is broadcast.
    placed = documents.select("id", F.xxhash64("text").alias("text_hash"), alphanumeric_words("text").alias("words"))
    placed = placed.select("id", "text_hash", "words", F.posexplode_outer("words").alias("at", "word"))
    index = small_side(lookups.withColumnRenamed("place", "ahead"))
    details = small_side(details)
    sizes = details.select("template", F.size("template_words").alias("n"))
    start = F.col("at") - F.col("ahead")
    candidates = placed.join(index, "word").join(sizes, "template").where(start >= 0).select(
        "id", "text_hash", "template", start.alias("start"), F.slice("words", start + 1, F.col("n")).alias("window")
    )
    compared = candidates.join(details, "template").select(
        "*",
        F.aggregate(
            F.zip_with("window", "template_words", lambda a, b: F.when(a == b, 1).otherwise(0)),
            F.lit(0), lambda total, same: total + same,
        ).alias("n_same"),
        F.size("template_words").alias("n"),
    )
    verified = compared.where(
        (F.col("n_same") >= F.col("coverage") * F.col("n"))
        & F.forall("phrases", lambda key: F.contains(_words(F.col("window")), F.concat(F.lit(" "), key, F.lit(" "))))
    )
    return verified.select(
        "id", "text_hash", "template", "label", "start", "n", (F.col("n_same") / F.col("n")).alias("coverage")
    ).distinct()


def scan(
    documents: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
    base: tuple[Template, ...] = BASE, notices: tuple[Template, ...] = NOTICES,
) -> DataFrame:
    """Of each row: its id, n_words, n_base, first_word, last_word, base_labels, labels, score, places.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased. ``n_base`` counts all places of
    the base phrases, ``first_word`` and ``last_word`` are the smallest and the largest of their starts (else
    null). Labels are distinct, sorted and comma-joined; ``labels`` has those of the base and of the notices.
    ``score`` is the largest share of a verified template's words, 0 without one. ``places`` lists
    (label, start, n) in order. Null and empty texts have no words and no places. Repeated documents come
    back as often as they occur; rows that share an id but not the text are judged alone. No documents
    give no rows. A notice that the end of the text cuts off can match as far as it goes. Other columns are not read.
    """
    documents = documents.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    found = matches(documents, base + notices)
    is_base = F.col("template") < len(base)

    def joined(labels: Column) -> Column:
        return F.concat_ws(",", F.sort_array(F.collect_set(labels)))

    own = found.groupBy(F.col("id").alias("own_id"), F.col("text_hash").alias("own_hash")).agg(
        F.count_if(is_base).alias("n_base"),
        F.min(F.when(is_base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(is_base, F.col("start"))).cast("long").alias("last_word"),
        joined(F.when(is_base, F.col("label"))).alias("base_labels"), joined(F.col("label")).alias("labels"),
        F.max("coverage").alias("score"),
        F.sort_array(F.collect_list(F.struct("start", "n", "label"))).alias("places"),
    )
    rows = documents.select(
        "id", F.xxhash64("text").alias("text_hash"),
        F.size(alphanumeric_words("text")).cast("long").alias("n_words"),
    )
    same = F.col("id").eqNullSafe(F.col("own_id")) & (F.col("text_hash") == F.col("own_hash"))
    return rows.join(own, same, "left").select(
        F.col("id").alias(id_column), "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word", "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"), "places",
    )
