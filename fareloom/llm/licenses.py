"""License scan by canonical digest.

Texts are brought to a canonical form (lower case, copyright lines gone, equivalent spellings made one, punctuation and
white space single blanks) and their digest is joined with those of known licenses. What is looked up is the whole
document, each run of paragraphs, each paragraph and each line, always as an entire text; a text whose canonical length
no known license has is not even hashed, nor a run that starts with another word. All of it is built-in expressions;
documents are read once and only hits are grouped. Work is linear in a text's paragraphs, up to many thousands of them.

The table of known licenses is given by the caller, or it is ``KNOWN`` and the full texts in ``license_texts``; its size
is checked before it is broadcast.

Defined cases: one row per id, so repeated rows of an id are answered together; null and empty texts have no hit; a
null id is an id; several ids for one canonical text all count; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_KNOWN = 10_000
BLOCK = 256  # paragraphs that are placed together
PIECE = 4096  # characters of a text that are cut together

# Notices and short licenses as published (fixed values).
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted.",
    ),
)

# Headings that a full text may have or not; the texts of the others contain theirs.
HEADINGS = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The 2-Clause BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The 3-Clause BSD License"),
}
END_OF_TERMS = "END OF TERMS AND CONDITIONS"

# Equivalent spellings: pattern and the form kept.
SPELLINGS = (("licence", "license"), ("sub license", "sublicense"), ("non commercial", "noncommercial"), ("and or", "or"))


def full_texts() -> list[tuple[str, str]]:
    """(license id, text) of the files in ``license_texts``, also under their headings and without what follows the terms."""
    found = []
    for file in sorted(resources.files(__package__).joinpath("license_texts").iterdir(), key=lambda f: f.name):
        name, text = file.name.removesuffix(".txt").split("+")[0], file.read_text(encoding="utf-8")
        found.append((name, text))
        found += [(name, f"{heading}\n\n{text}") for heading in HEADINGS.get(name, ())]
        if END_OF_TERMS in text:
            terms = text[: text.index(END_OF_TERMS)]
            found += [(name, terms), (name, terms + END_OF_TERMS)]
    return found


def canonical_lines(text: Column) -> Column:
    """Canonical form with line breaks kept."""
    form = F.regexp_replace(F.lower(text), "\\r\\n?", "\n")
    # A wrapped line of terms may start with the same word.
    terms = "[ \\t]+(notices?|holders?|owners?|laws?|licen[sc]es?|statements?|interests?|and|or|in|to|of|is|on|for)\\b"
    notice = f"copyright(?!{terms})|\\(c\\)(?![ \\t]+(you|under|for|if|any)\\b)|©|all rights reserved\\.?[ \\t]*(?=\\n|$)"
    form = F.regexp_replace(form, f"(^|\\n)[ \\t]*({notice})[^\\n]*", "$1")
    form = F.regexp_replace(form, "[^\\p{L}\\p{N}\\n]+", " ")
    for pattern, kept in SPELLINGS:
        form = F.replace(form, F.lit(pattern), F.lit(kept))
    return form


def flat(form: Column) -> Column:
    """One canonical text without line breaks."""
    return F.trim(F.regexp_replace(form, "[ \\n]+", " "))


def known_digests(known: DataFrame) -> DataFrame:
    """``license_id, digest, size`` of a table ``known(license_id, text)``."""
    form = known.select("license_id", flat(canonical_lines(F.col("text"))).alias("form")).filter("form <> ''")
    return form.select(
        "license_id",
        F.md5("form").alias("digest"),
        F.char_length("form").alias("size"),
        F.substring_index("form", " ", 1).alias("head"),
    ).distinct()


def placed_blocks(paragraphs: Column) -> Column:
    """Blocks of ``BLOCK`` paragraphs: the ``next`` free place, and ``start, size, head`` of ``all`` paragraphs, as if each
    block began the text. Appending to an array copies it, so arrays that grow are kept short."""
    none = F.array().cast("array<struct<start:int,size:int,head:string>>")

    def place(so_far: Column, at: Column) -> Column:
        p = F.get(paragraphs, at)
        size = F.char_length(p)
        own = F.struct(so_far["next"].alias("start"), size.alias("size"), F.substring_index(p, " ", 1).alias("head"))
        return F.struct((so_far["next"] + size + 1).alias("next"), F.concat(so_far["all"], F.array(own)).alias("all"))

    def block(first: Column) -> Column:
        last = F.least(first + BLOCK, F.size(paragraphs)) - 1
        start = F.struct(F.lit(1).alias("next"), none.alias("all"))
        return F.aggregate(F.sequence(first, last), start, place)

    return F.transform(F.sequence(F.lit(0), F.size(paragraphs) - 1, F.lit(BLOCK)), block)


def placed_paragraphs(blocks: Column) -> Column:
    """``start, size, head`` of each paragraph in the text that they make up with single blanks between them."""

    def add(so_far: Column, block: Column) -> Column:
        end = F.element_at(so_far, -1) + block["next"] - 1
        return F.concat(so_far, F.array(end))

    def moved(pair: Column) -> Column:
        return F.transform(
            pair["blocks"]["all"],
            lambda p: F.struct((p["start"] + pair["before"]).alias("start"), p["size"].alias("size"), p["head"].alias("head")),
        )

    before = F.aggregate(blocks, F.array(F.lit(0)), add)
    paired = F.arrays_zip(blocks.alias("blocks"), F.slice(before, F.lit(1), F.size(blocks)).alias("before"))
    return F.flatten(F.transform(paired, moved))


def cut(pieces: Column, start: Column, size: Column) -> Column:
    """``size`` characters from ``start`` (from 1) of a text in pieces of ``PIECE``: the work follows what is cut out."""
    first, last = F.floor((start - 1) / PIECE).cast("int"), F.floor((start + size - 2) / PIECE).cast("int")
    around = F.array_join(F.transform(F.sequence(first, last), lambda at: F.get(pieces, at)), "")
    return F.substr(around, start - first * PIECE, size)


def runs(wanted: Column) -> Column:
    """Every run of two paragraphs or more that has the size and first word of a known text."""

    def of_size(k: Column) -> Column:
        starts = F.filter("headed", lambda p: (p["head"] == k["head"]) & (p["size"] < k["size"]))
        stops = F.array_intersect(F.transform(starts, lambda p: p["start"] + k["size"]), "stops")
        return F.transform(stops, lambda stop: cut(F.col("pieces"), stop - k["size"], k["size"]))

    fitting = F.filter(wanted, lambda k: k["size"] <= F.col("length"))
    return F.coalesce(F.flatten(F.transform(fitting, of_size)), F.array().cast("array<string>"))


def scan(docs: DataFrame, known: DataFrame | None = None, max_known: int = MAX_KNOWN) -> DataFrame:
    """``doc_id, licenses, hits, whole`` per id: sorted license ids in one text, the lines, paragraphs of several
    lines and runs of paragraphs that are a license (one within another counts too), and whether all of a document is
    one."""
    spark: SparkSession = docs.sparkSession
    if known is None:
        known = spark.createDataFrame([*KNOWN, *full_texts()], "license_id string, text string")
    digests = known_digests(known)
    count = digests.count()
    if count > max_known:
        raise ValueError(f"{count} known texts; raise max_known to broadcast that many")
    shapes = sorted((r.size, r.head) for r in digests.select("size", "head").distinct().collect())  # at most max_known
    sizes = F.array(*[F.lit(size) for size in sorted({size for size, _ in shapes})])
    heads = F.array(*[F.lit(head) for head in sorted({head for _, head in shapes})])
    wanted = F.array(*[F.struct(F.lit(size).alias("size"), F.lit(head).alias("head")) for size, head in shapes])

    lines = F.split("form", "\\n")
    paragraphs = F.filter(F.split("form", "\\n *\\n[ \\n]*"), lambda p: p.rlike("[^ \\n] *\\n[ \\n]*[^ \\n]"))
    parts = F.concat(
        F.array(F.struct(F.lit(True).alias("whole"), F.col("joined").alias("unit"))),
        F.transform(
            F.concat(F.transform(paragraphs, flat), F.transform(lines, lambda line: F.trim(line)), runs(wanted)),
            lambda u: F.struct(F.lit(False).alias("whole"), u.alias("unit")),
        ),
    )
    candidates = F.filter(parts, lambda u: F.array_contains(sizes, F.char_length(u["unit"])))
    split = F.filter(F.transform(F.split("form", "\\n *\\n[ \\n]*"), flat), lambda p: p != "")
    starts_one = F.exists("split", lambda p: F.array_contains(heads, F.substring_index(p, " ", 1)))
    blocks = F.when((F.size("split") > 1) & starts_one, placed_blocks(F.col("split")))
    pieces = F.when(F.col("blocks").isNotNull(), F.regexp_extract_all("joined", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)))
    placed = F.when(F.col("blocks").isNotNull(), placed_paragraphs(F.col("blocks")))
    found = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), canonical_lines(F.col("text").cast("string")).alias("form"))
        .select("doc_id", "form", split.alias("split"))
        .select("doc_id", "form", F.array_join("split", " ").alias("joined"), blocks.alias("blocks"))
        .select("doc_id", "form", "joined", pieces.alias("pieces"), placed.alias("placed"))
        .select(
            "doc_id",
            "form",
            "joined",
            "pieces",
            F.char_length("joined").alias("length"),
            F.filter("placed", lambda p: F.array_contains(heads, p["head"])).alias("headed"),
            F.transform("placed", lambda p: p["start"] + p["size"]).alias("stops"),
        )
        .select("doc_id", F.explode_outer(candidates).alias("u"))
        .select("doc_id", "u.whole", F.md5("u.unit").alias("digest"))
    )
    return (
        found.join(F.broadcast(digests.drop("size", "head")), "digest", "left")
        .groupBy("doc_id")
        .agg(
            F.array_join(F.array_sort(F.collect_set("license_id")), " ").alias("licenses"),
            F.count(F.when(~F.col("whole"), F.col("license_id"))).alias("parts"),
            F.coalesce(F.max(F.col("whole") & F.col("license_id").isNotNull()), F.lit(False)).alias("whole"),
        )
        .select("doc_id", "licenses", F.greatest("parts", F.col("whole").cast("long")).alias("hits"), "whole")
    )
