"""Document fingerprints from spot signatures.

Common words are anchors. After each anchor stands a chain of the next content words; other common
words in between are skipped. Anchor and chain together are a spot signature, and a document's
fingerprint is the set of its signatures: what is in a text between template words, not where.
"""

import math
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, functions as F

from tristrata.llm.components import components
from tristrata.llm.rows import Shelf, fresh, text_of
from tristrata.operators import keys

# Function words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be by for from in is it of on or that the this to was were which with "
    "das dem den der des die ein eine einer für im ist mit nicht sich und von zu auf auch "
    "au aux avec ce dans de du en est et il la le les par pas pour que qui sur un une "
    "con del el es las lo los no para por se su y"
).split()
ROUNDS = 4  # further leaders of a meeting before its remaining components are compared in pairs
CHAIN = 2  # content words of a signature
PARITIES = ("p0", "p1", "p2", "p3")


def _tree(words: list[str]) -> str:
    """A pattern for a set of words that shares their common beginnings."""
    heads: dict[str, list[str]] = {}
    for w in words:
        if w:
            heads.setdefault(w[0], []).append(w[1:])
    options = "|".join(c + _tree(rest) for c, rest in sorted(heads.items()))
    if not options:
        return ""
    return f"(?:{options}){'?' if '' in words else ''}"


def with_signatures(df: DataFrame, text: str, name: str, anchors: list[str] = ANCHORS, chain: int = CHAIN) -> DataFrame:
    """``df`` with the spot signatures of a text column as sorted numbers of 32 bits, each once.

    Letter case and all but letters and digits are ignored. A text without a full chain has one
    signature, of all it says (of its symbols if it has no word); an empty text has none. Words and
    spots are columns of their own on the way, as an expression that needs them twice would find them twice.
    """
    common = _tree(sorted(set(anchors)))
    words, spots = fresh([*df.columns, name], "words", "spots")
    link = r"(?:~[^ ]+ )*+[^~ ][^ ]* "
    marked = F.regexp_replace(F.col(words), f"(?<= )(?={common} )", "~")
    said = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), F.lit(" "))
    found = F.transform(F.col(spots), lambda s: F.crc32(F.regexp_replace(s, r"(?<= )~[^ ]+ ", "")))
    whole = F.when(F.col(words) != "  ", F.col(words)).otherwise(F.col(text))
    alone = F.when(F.col(text) == "", F.array().cast("array<bigint>")).otherwise(F.array(F.crc32(whole)))
    return (
        df.withColumn(words, said)
        .withColumn(spots, F.regexp_extract_all(marked, F.lit(rf"(?<= )(?=(~[^ ]+ {link * chain}))"), F.lit(1)))
        .withColumn(name, F.sort_array(F.array_distinct(F.when(F.size(spots) > 0, found).otherwise(alone))))
        .drop(words, spots)
    )


def packed(found: Column) -> Column:
    """Signatures as signed numbers of 32 bits in the same order: half as wide where they are stored or moved."""
    return F.transform(found, lambda s: (s - 2**31).cast("int"))


def unpacked(found: Column) -> Column:
    return F.transform(found, lambda s: s.cast("long") + 2**31)


def fingerprint(found: Column) -> Column:
    """Signatures as one string, eight hexadecimal digits each."""
    return F.array_join(F.transform(found, lambda s: F.lpad(F.hex(s), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets of signatures; 1 if both are empty."""
    shared = F.size(F.array_intersect(a, b))
    total = F.size(a) + F.size(b) - shared
    return F.when(total == 0, 1.0).otherwise(shared / total)


def _parities(sig: Column) -> list[Column]:
    """Whether a set has an odd number of signatures in each of 256 places, as four aggregates of 64 bits."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), sig.bitwiseAND(F.lit(63)).cast("int"))
    word = F.shiftright(sig, 6).bitwiseAND(F.lit(len(PARITIES) - 1))
    return [F.bit_xor(F.when(word == k, bit).otherwise(F.lit(0).cast("long"))).alias(p) for k, p in enumerate(PARITIES)]


def near_classes(prints: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``id`` and ``component`` of every id that is linked with another one.

    ``prints`` has (id, found): signatures by ``with_signatures``. Two sets are linked at a likeness of
    at least ``threshold``; empty sets with nothing. Sets are partitioned by length, with bounds so
    far apart that a pair can only be in one partition or two neighbouring ones. In a partition they
    meet by their rarest signatures, as many as a pair above the threshold must share one of;
    signatures of one set come first among those and meet nothing, so most sets need not go on. Stars
    around the smallest id of a meeting are compared first, then stars around other members; sets which
    stay apart in spite of that are compared where their components differ and their lengths and the
    parities of their signatures allow it: no pair above the threshold fails these.
    """
    shelf = Shelf(prints)
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sets = shelf.put(prints.where("id is not null and size(found) > 0").groupBy("id").agg(F.first("found").alias("found")), "sets")
    one = sets.select("id", F.size("found").alias("n"), F.explode("found").alias("sig")).repartition(parts, "sig")
    rarity = one.groupBy("sig").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    rows = one.join(rarity.hint("shuffle_hash"), "sig").groupBy("id", "n").agg(
        F.sort_array(F.collect_list(F.struct("df", "sig"))).alias("by"), *_parities(F.col("sig"))
    )
    need = F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1 - (F.col("n") - F.size("by"))
    part = F.floor(F.log(F.col("n").cast("double")) / -math.log(threshold) + 1e-9)
    prefixes = shelf.put(
        rows.where(need > 0).select(
            "id", "n", part.alias("own"), F.transform(F.slice("by", 1, need.cast("int")), lambda s: s["sig"]).alias("by"),
            (F.col("n") - F.size("by")).alias("unique"), *PARITIES,
        ),
        "prefixes",
    )
    meetings = shelf.put(
        prefixes.select("id", "n", "own", F.explode("by").alias("sig")).select(
            "id", "n", F.explode(F.array("own", F.col("own") + 1)).alias("part"), "sig"
        ),
        "meetings",
    )
    prefixes = prefixes.drop("n")
    stars = meetings.groupBy("sig", "part").agg(F.min("id").alias("leader"), F.max("id").alias("_last")).where("leader != _last")
    rays = meetings.join(stars, ["sig", "part"]).where("id != leader").select(F.col("leader").alias("a"), F.col("id").alias("b"))

    def verified(pairs: DataFrame) -> DataFrame:
        left = sets.select(F.col("id").alias("a"), F.col("found").alias("_x"))
        right = sets.select(F.col("id").alias("b"), F.col("found").alias("_y"))
        bound = F.least(F.size("_x"), F.size("_y")) >= threshold * F.greatest(F.size("_x"), F.size("_y")) - 1e-9
        both = pairs.distinct().join(right, "b").join(left, "a").where(bound)
        return both.where(likeness(F.col("_x"), F.col("_y")) >= threshold).select("a", "b")

    links = shelf.put(verified(rays), "links")
    first = shelf.put(components(links), "components")

    def place(known: DataFrame) -> DataFrame:
        return meetings.join(known, "id", "left").withColumn("component", F.coalesce("component", "id"))

    # Another leader each time, for the members that are not in its component: near copies of one text
    # come together this way, whichever of them the first leader was.
    for r in range(ROUNDS):
        placed = place(first)
        other = F.struct(F.xxhash64("id", F.lit(r)).alias("h"), F.col("id").alias("lead"), F.col("component").alias("home"))
        leads = placed.groupBy("sig", "part").agg(F.min(other).alias("l"), F.min("component").alias("_c"), F.max("component").alias("_d"))
        leads = leads.where("_c != _d").select("sig", "part", "l.lead", "l.home")
        rays = placed.join(leads, ["sig", "part"]).where("component != home").select(
            F.least("id", "lead").alias("a"), F.greatest("id", "lead").alias("b")
        )
        more = shelf.put(verified(rays), "links")
        if more.isEmpty():
            break
        links = links.unionByName(more)
        shelf.drop(first)
        first = shelf.put(components(links), "components")
    # The largest component of a meeting is not compared with itself.
    spread = place(first).groupBy("sig", "part", "component").agg(F.count(F.lit(1)).alias("_m"))
    apart = spread.groupBy("sig", "part").agg(F.max(F.struct("_m", "component")).alias("_h"), F.count(F.lit(1)).alias("_k")).where("_k > 1")
    open_meetings = apart.select("sig", "part", F.col("_h.component").alias("home"))
    rest = place(first).join(open_meetings, ["sig", "part"]).join(prefixes, "id")
    other = rest.drop("home").withColumnsRenamed({c: f"_{c}" for c in rest.columns if c not in ("sig", "part", "home")})
    # A pair is made where it meets first: at the first signature both have, in the upper of their partitions.
    first_meeting = (F.get(F.array_intersect("by", "_by"), F.lit(0)) == F.col("sig")) & (F.col("part") == F.greatest("own", "_own"))
    once = (F.col("_component") == F.col("home")) | (F.col("component") < F.col("_component"))
    lengths = F.least("n", "_n") >= threshold * F.greatest("n", "_n") - 1e-9
    # What two sets do not share: signatures of one set only, and one at least for each parity that differs.
    differ = reduce(add, (F.bit_count(F.col(p).bitwiseXOR(F.col(f"_{p}"))) for p in PARITIES), F.col("unique") + F.col("_unique"))
    few = differ <= (F.col("n") + F.col("_n")) * ((1 - threshold) / (1 + threshold)) + 1e-6
    more = rest.where("component != home").join(other, ["sig", "part"]).where(
        (F.col("component") != F.col("_component")) & once & lengths & few & first_meeting
    ).select(F.least("id", "_id").alias("a"), F.greatest("id", "_id").alias("b"))
    out = components(links.unionByName(shelf.put(verified(more), "links")))
    for stored in (sets, meetings, first):
        shelf.drop(stored)
    return out


def _spot(id_col: Column, key: Column, start: str) -> list[Column]:
    """Columns by which a document is found, none of them null."""
    return [
        id_col.isNull().alias(f"{start}_none"), F.coalesce(id_col.cast("string"), F.lit("")).alias(f"{start}_name"), key.alias(f"{start}_key"),
    ]


def _meet(left: DataFrame, a: str, right: DataFrame, b: str) -> Column:
    return reduce(and_, (left[f"{a}_{part}"] == right[f"{b}_{part}"] for part in ("none", "name", "key")))


def _signed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Each document with its place, a hash of its text, its length and its signatures, packed."""
    named = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).withColumn("key", F.xxhash64("text"))
    signed = with_signatures(named, "text", "found")
    return signed.select("id", "key", F.length("text").alias("n"), packed(F.col("found")).alias("found"))


def _neighbours(signed: DataFrame, shelf: Shelf) -> DataFrame:
    """From which document to which what goes, and how many characters the latter wants.

    Documents find their neighbour by rank, so no task sees the whole order.
    """
    ids = shelf.put(signed.groupBy("id", "key", "n").count().drop("count"), "ids")
    ranks = shelf.put(keys.dense_key(ids, "rank", ["id", "key"]), "ranks")
    n = ranks.count()
    # Rank 1 is the last in descending order; its next one is rank n.
    asks = ranks.select(
        F.when(F.col("rank") == 1, n).otherwise(F.col("rank") - 1).alias("rank"),
        *_spot(F.col("id"), F.col("key"), "to"), F.floor(F.col("n") / 2).cast("int").alias("want"),
    )
    out = shelf.put(
        ranks.drop("n").join(asks, "rank").select(*_spot(F.col("id"), F.col("key"), "from"), "to_none", "to_name", "to_key", "want"), "sends"
    )
    shelf.drop(ids)
    shelf.drop(ranks)
    return out


def _edited(docs: DataFrame, sends: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """For each document the digest and the signatures of its edited text.

    Whole texts travel once, and both joins read that exchange; each document sends its neighbour the
    characters that one needs and no more. Rows that repeat an id and a text give one.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = text_of(text_col)
    texts = docs.select(*_spot(F.col(id_col), F.xxhash64(text), "at"), text.alias("text"))
    texts = texts.repartition(parts, "at_none", "at_name", "at_key")
    given = texts.join(sends.hint("shuffle_hash"), _meet(texts, "at", sends, "from"))
    heads = given.select("to_none", "to_name", "to_key", F.substring(F.col("text"), F.lit(1), F.col("want")).alias("head"))
    heads = heads.groupBy("to_none", "to_name", "to_key").agg(F.first("head").alias("head"))
    kept = F.substring(F.col("text"), F.lit(1), F.length("text") - F.floor(F.length("text") / 2).cast("int"))
    both = texts.join(heads, _meet(texts, "at", heads, "to")).select("at_none", "at_name", "at_key", F.concat(kept, "head").alias("edited"))
    once = with_signatures(both, "edited", "found").select(
        "at_none", "at_name", "at_key", F.sha2("edited", 256).alias("edited_sha256"), packed(F.col("found")).alias("edited_found")
    )
    return once.groupBy("at_none", "at_name", "at_key").agg(F.first("edited_sha256").alias("edited_sha256"), F.first("edited_found").alias("edited_found"))


def compare_edits(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float | None = None, name: str = "class_id"
) -> DataFrame:
    """Every document's fingerprint beside that of its edited text, and its likeness to both neighbours.

    The edited text has the last floor(n/2) characters replaced by the first as many (or all) of the
    next document in descending order of id (null last, ties by a hash of the text, the first one
    after the last). With a ``threshold`` a further column ``name`` has the class of the fingerprint
    among all near ones: the least hash of the fingerprints that links connect; texts with the same
    fingerprint are compared once, and an empty one has no class. Null texts count as empty. Rows that
    repeat an id and a text are one document and give equal rows; an empty table gives none; a long text
    is signed whole. Other columns are not read. Signatures of all documents are written once, as numbers.
    """
    shelf = Shelf(docs)
    signed = shelf.put(_signed(docs, id_col, text_col), "signed")
    sends = _neighbours(signed, shelf)
    edits = shelf.put(_edited(docs, sends, id_col, text_col), "edits")
    print_key = F.when(F.size("found") > 0, F.xxhash64("found"))
    classes = None
    if threshold is not None:
        prints = signed.select(print_key.alias("id"), "found").where("id is not null")
        classes = shelf.put(near_classes(prints, threshold), "classes").select(F.col("id").alias("_near"), F.col("component").alias("_class"))
    own = signed.select(*_spot(F.col("id"), F.col("key"), "at"), "id", "n", "found")
    after = own.join(sends, _meet(own, "at", sends, "from")).groupBy("to_none", "to_name", "to_key").agg(F.first("found").alias("next_found"))
    edits = edits.withColumnsRenamed({f"at_{part}": f"of_{part}" for part in ("none", "name", "key")})
    both = own.join(edits, _meet(own, "at", edits, "of")).join(after, _meet(own, "at", after, "to"))
    columns = [
        F.col("id").alias(id_col), F.col("n").cast("long").alias("n_chars"), F.col("edited_sha256"),
        fingerprint(unpacked(F.col("found"))).alias("fingerprint"), fingerprint(unpacked(F.col("edited_found"))).alias("edited_fingerprint"),
        likeness(F.col("found"), F.col("edited_found")).alias("near_edited"), likeness(F.col("found"), F.col("next_found")).alias("near_next"),
    ]
    if classes is None:
        return both.select(*columns)
    placed = both.withColumn("_print", print_key)
    return placed.join(classes, F.col("_print") == F.col("_near"), "left").select(*columns, F.coalesce("_class", "_print").alias(name))
