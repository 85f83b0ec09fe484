"""Document fingerprints as Merkle trees, in DataFrame functions only.

A text is cut into paragraphs (lines), and these into clauses (each up to punctuation, signs that follow it and a blank, or
up to a full-width mark). A clause of more than `LONG` characters is cut by its content, after each word, or each sign of
scripts written without blanks, whose hash says so, on average every eighth; so text without punctuation has clauses too, and an edit
moves no border but its own. Cuts lose no character. Clauses are hashed; a paragraph's hash is that of its clause hashes, a
section's that of its paragraph hashes, and the root that of the section hashes. A section ends after a
paragraph whose hash says so, on average every fourth, so an edit moves no border beyond its own
section. Equal texts have equal trees; where roots differ, equal section and paragraph hashes
rule out branches, and what is left holds the edits.

A fingerprint is the whole tree as one string of four parts, joined by `/`: the root; the section hashes,
joined by `|`; the paragraph hashes, joined by `;` and, where a section begins, by `|`; the clause hashes,
joined by `,` within a paragraph and between paragraphs as above. Likeness is the Dice
coefficient of the sets of clause hashes, and 1 only for equal roots.

`with_successors` finds what follows each row in the order of ids without a window over texts: ids alone are
put in order by range, and a text's beginning is sent to its predecessor by an ordinary join on the
unique id. The texts are shuffled once: both joins read that shuffle.

Defined cases. Null text is the empty text, which has one empty paragraph and clause. A row with a null id
comes before all others; rows that share an id follow each other by the hash of their text. Repeated
rows are one document and give one row. One row alone is its own successor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtide.llm.common import durable, text_key, whole

# Java patterns; what they match has no width, so the pieces joined give the text.
PARAGRAPH_END = r"(?<=\n)(?!\z)"
MARKS = "。，、；：！？．"
CLAUSE_END = rf"(?<=[.,;:!?][^\p{{L}}\p{{N}}\s]{{0,3}}[ \t])(?=.)|(?<=[{MARKS}])(?=.)"
LONG = 120  # characters of a clause that is cut by its content
# A sign of a script without blanks; a word of others with the blanks after it; blanks.
SIGNS = r"\x{3040}-\x{30FF}\x{3400}-\x{9FFF}"
PIECE = rf"[{SIGNS}]|[^ \t\r\n{SIGNS}]+[ \t\r\n]*|[ \t\r\n]+"
BORDER = "\x01"  # marks cuts while they are made; a clause that holds it is not cut
LEAF, BRANCH = 8, 16  # hex digits kept of a clause's hash and of a paragraph's or section's


def _branch(value: Column) -> Column:
    return F.left(F.md5(value), F.lit(BRANCH))


def _by_content(clause: Column) -> Column:
    """A clause as it is, or a long one in pieces."""
    marked = F.transform(
        F.regexp_extract_all(clause, F.lit(PIECE), F.lit(0)),
        lambda piece: F.when(F.left(F.md5(piece), F.lit(1)) < "2", F.concat(piece, F.lit(BORDER))).otherwise(piece),
    )
    pieces = F.filter(F.split(F.array_join(marked, ""), BORDER, -1), lambda piece: piece != "")
    long = (F.length(clause) > LONG) & (F.instr(clause, BORDER) == 0)
    return F.when(long, pieces).otherwise(F.array(clause))


def with_fingerprint(df: DataFrame, text_col: str, name: str) -> DataFrame:
    """`df` with the fingerprint of a text column under `name`."""
    clauses, paragraphs, sections = (f"__{name}_{level}" for level in ("clauses", "paragraphs", "sections"))

    def border(n: Column) -> Column:
        before = F.left(F.get(F.col(paragraphs), n - 1), F.lit(1))
        return F.when(n == 0, "").when(before < "4", "|").otherwise(";")

    def outline(nodes: Column, of_node) -> Column:
        return F.array_join(F.transform(nodes, lambda node, n: F.concat(border(n), of_node(node))), "")

    cut = F.transform(
        F.split(whole(F.col(text_col)), PARAGRAPH_END, -1),
        lambda paragraph: F.transform(
            F.flatten(F.transform(F.split(paragraph, CLAUSE_END, -1), _by_content)), lambda clause: F.md5(clause)
        ),
    )
    leaves = outline(
        F.col(clauses), lambda row: F.array_join(F.transform(row, lambda leaf: F.left(leaf, F.lit(LEAF))), ",")
    )
    return (
        df.withColumn(clauses, cut)
        .withColumn(paragraphs, F.transform(clauses, lambda row: _branch(F.array_join(row, ","))))
        .withColumns({paragraphs: outline(F.col(paragraphs), lambda node: node), clauses: leaves})
        .withColumn(sections, F.array_join(F.transform(F.split(paragraphs, r"\|"), _branch), "|"))
        .withColumn(name, F.concat_ws("/", F.md5(sections), sections, paragraphs, clauses))
        .drop(clauses, paragraphs, sections)
    )


def root(fingerprint: Column) -> Column:
    return F.substring_index(fingerprint, "/", 1)


def leaves(fingerprint: Column) -> Column:
    """The set of clause hashes."""
    return F.array_distinct(F.split(F.substring_index(fingerprint, "/", -1), "[,;|]"))


def likeness(a: Column, b: Column) -> Column:
    """Share of clause hashes in common, 0 to 1; 1 only if the roots are equal."""
    ours, theirs = leaves(a), leaves(b)
    total = F.size(ours) + F.size(theirs)
    dice = F.size(F.array_intersect(ours, theirs)) * F.lit(2.0) / total
    return F.when(root(a) == root(b), F.lit(1.0)).otherwise(F.least(dice, 1 - F.lit(1.0) / (total + 1)))


def edited_paragraphs(a: Column, b: Column) -> Column:
    """Where the text of `a` differs from that of `b`: numbers, from 0, of paragraphs whose branch `b` lacks.

    Sections that `b` has are passed over whole; only the others are searched by paragraph.
    """
    def part(fingerprint: Column, n: int) -> Column:
        return F.element_at(F.split(fingerprint, "/"), n)

    def numbered(fingerprint: Column) -> Column:
        starts = F.transform(
            F.split(part(fingerprint, 3), r"\|"),
            lambda section: F.struct(_branch(section).alias("hash"), F.split(section, ";").alias("paragraphs")),
        )
        return starts

    known_sections = F.split(part(b, 2), r"\|")
    known = F.split(part(b, 3), "[;|]")
    flat = F.flatten(
        F.transform(
            numbered(a),
            lambda section: F.transform(
                section["paragraphs"],
                lambda paragraph: F.struct(
                    paragraph.alias("hash"), F.array_contains(known_sections, section["hash"]).alias("same")
                ),
            ),
        )
    )
    marked = F.transform(flat, lambda node, n: F.struct(n.alias("n"), node["hash"].alias("hash"), node["same"].alias("same")))
    left = F.filter(marked, lambda node: ~node["same"] & ~F.array_contains(known, node["hash"]))
    return F.when(root(a) == root(b), F.array().cast("array<int>")).otherwise(F.transform(left, lambda node: node["n"]))


def successors(ids: DataFrame, keys: list[str]) -> DataFrame:
    """Each row of distinct keys with those of the next in their order, the first one's for the last: next_<key>.

    Ranges of the keys are numbered in order; a row's successor is in its range, or else the first of the
    next range that has rows. The table of first rows has one row per range.
    """
    ranged = ids.repartitionByRange(*keys).withColumn("__range", F.spark_partition_id())
    ranged = durable(ranged, "ranges")
    row = F.struct(*keys)
    within = ranged.withColumn("__next", F.lead(row).over(Window.partitionBy("__range").orderBy(*keys)))
    firsts = ranged.groupBy("__range").agg(F.min(row).alias("__first"))
    in_order = Window.orderBy("__range")
    wrapped = F.first("__first").over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    following = firsts.select("__range", F.coalesce(F.lead("__first").over(in_order), wrapped).alias("__after"))
    joined = within.join(F.broadcast(following), "__range").withColumn("__next", F.coalesce("__next", "__after"))
    return joined.select(*ids.columns, *[F.col("__next")[k].alias(f"next_{k}") for k in keys])


def with_successors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id_col, text, edited (the contract's edit), and of the next one its id (next_<id_col>)
    and fingerprint (next_print)."""

    def named(id_: str, key: str) -> Column:
        return F.concat_ws(":", F.coalesce(F.col(id_).cast("string"), F.lit("")), F.col(key))

    texts = docs.select(
        F.col(id_col), whole(F.col(text_col)).alias("text"), text_key(F.col(text_col)).alias("__key")
    )
    ids = texts.select(id_col, "__key", F.length("text").alias("size")).distinct()
    order = durable(successors(ids, [id_col, "__key"]), "successors")
    asked = order.select(
        named(f"next_{id_col}", "next___key").alias("__row"), named(id_col, "__key").alias("__to"),
        F.floor(F.col("size") / 4).cast("int").alias("wanted"),
    )
    # Rows stay sorted by __row from the joins on, so taking the first of repeated rows costs no further sort.
    # Both joins ask for the same columns of the texts, so that the second reads the first one's shuffle.
    following = f"next_{id_col}"
    texts = texts.select(id_col, "text", named(id_col, "__key").alias("__row"))
    heads = texts.join(asked, "__row").groupBy("__row").agg(
        F.first(id_col).alias(following), *[F.first(c).alias(c) for c in ("text", "__to", "wanted")]
    )
    sent = with_fingerprint(heads, "text", "next_print").select(
        F.col("__to").alias("__row"), following, "wanted", F.expr("left(text, wanted)").alias("head"), "next_print"
    )
    rows = texts.join(sent, "__row").groupBy("__row").agg(
        *[F.first(c).alias(c) for c in (id_col, "text", following, "wanted", "head", "next_print")]
    )
    edited = F.expr("concat(left(text, length(text) - wanted), head)").alias("edited")
    return rows.select(id_col, "text", edited, following, "next_print")
