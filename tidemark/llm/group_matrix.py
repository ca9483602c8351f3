"""Documents that share most of their word n-grams: a similarity join through a token-group matrix.

Rows with equal sets of n-grams form a class. Similar classes are put into groups of
bounded size; the matrix says which group has which token in the union of its members'.
How many tokens of a query class a group's union holds bounds the overlap with each
member, so only groups that can hold a partner are opened and compared set by set.

Only a prefix of each set takes part in the matrix: of two sets similar enough, the
prefixes share a token, and in fact a certain count. Prefixes take tokens in one
order for all, frequent ones last, so passages that many documents share do not pull
unrelated documents together.

What is asked for is the components of the links, so groups whose members are linked
already are not compared again, and an opened group reports one link per component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words
from tidemark.llm.components import components
from tidemark.session import write_through

#: Classes in a group, queries that meet it in one task.
GROUP, QUERIES = 128, 256
#: Percent of a prefix that a class shares with the head of its family.
FAMILY = 25
#: Bits of the filter that says which texts to read again.
SLOTS = 1 << 22
#: Prefix tokens in more rows than this go last in the order, at most so many of them;
#: the order is a matter of speed, any gives the same links.
FREQUENT, MOST_FREQUENT = 20, 200_000


def prefix_size(n, percent: int):
    """Tokens of a set of ``n`` of which one at least is shared with any partner's prefix."""
    need = n * percent + 99
    return n - (F.floor(need / 100) if isinstance(n, Column) else need // 100) + 1


class Order:
    """The order of tokens: those with a frequent upper half last, else by hash."""

    def __init__(self, frequent: np.ndarray) -> None:
        self.frequent = np.sort(frequent)
        self.maybe = np.zeros(1 << 22, dtype=bool)
        self.maybe[self.frequent >> 10] = True

    def late(self, tokens: np.ndarray) -> np.ndarray:
        out = self.maybe[(tokens >> np.uint64(42)).astype(np.int64)]
        some = np.flatnonzero(out)
        if len(some):
            upper = (tokens[some] >> np.uint64(32)).astype(np.uint32)
            place = np.minimum(np.searchsorted(self.frequent, upper), len(self.frequent) - 1)
            out[some] = self.frequent[place] == upper
        return out


def _digest(tokens: np.ndarray) -> int:
    mixed = words.mix(tokens * np.uint64(0x9E3779B97F4A7C15) + np.uint64(len(tokens)))
    return int(words.mix(np.array([mixed.sum(dtype=np.uint64)]))[0].view(np.int64))


def _sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        for part in words.slices(batch, "text"):
            yield part, *words.shingle_sets(words.tokenize(part.column("text")), n)


def _frequent(slim: DataFrame, n: int, percent: int) -> np.ndarray:
    """Upper halves of tokens in the prefixes, by hash alone, of more than ``FREQUENT`` rows: at most ``MOST_FREQUENT``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, tokens, first in _sets(batches, n):
            size = np.diff(first)
            take = np.minimum(prefix_size(size, percent) * 5 // 4 + 4, size)
            rows = np.repeat(np.arange(len(size)), take)
            place = np.arange(len(rows)) - np.repeat(np.cumsum(take) - take, take)
            upper = (tokens[first[rows] + place] >> np.uint64(32)).astype(np.uint32)
            yield pa.RecordBatch.from_arrays([pa.array(upper.view(np.int32))], ["t"])

    counts = slim.select("text").mapInArrow(run, "t int").groupBy("t").agg(F.count("*").alias("k"))
    counts = write_through(counts.filter(F.col("k") > FREQUENT), "frequent")
    # How many tokens are how frequent, in steps of a sixteenth of a doubling, decides from which step they fit.
    step = F.floor(F.log2("k") * 16)
    held, least = 0, None
    for s, many in sorted(map(tuple, counts.groupBy(step.alias("s")).count().collect()), reverse=True):
        if held + many > MOST_FREQUENT:
            break
        held, least = held + many, s
    if least is None:
        return np.zeros(0, dtype=np.uint32)
    top = counts.filter(step >= least).select("t").toPandas()
    return top["t"].to_numpy(dtype=np.int32).view(np.uint32)


def _signatures(slim: DataFrame, n: int, percent: int, order: Order) -> DataFrame:
    """(id, n, cls, central, prefix) per row; ``cls`` is a digest of the whole set.

    ``central`` says how many of its tokens are frequent: copies of a text that many
    were made from have the most.
    """
    shared = slim.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = shared.value
        for part, tokens, first in _sets(batches, n):
            late = order.late(tokens)
            size = np.diff(first)
            cls, central, kept, ends = [], [], [], [0]
            for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
                if a == b:
                    cls.append(None)
                    central.append(0)
                    ends.append(ends[-1])
                    continue
                row, slow = tokens[a:b], late[a:b]
                p = prefix_size(b - a, percent)
                seen = min(b - a, p * 5 // 4 + 4)
                prefix = row[~slow][:p]
                if len(prefix) < p:
                    prefix = np.concatenate([prefix, row[slow][: p - len(prefix)]])
                cls.append(_digest(row))
                central.append(int(slow[:seen].sum() * 255 // seen))
                kept.append(prefix)
                ends.append(ends[-1] + len(prefix))
            flat = np.concatenate(kept) if kept else np.zeros(0, dtype=np.uint64)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(size, pa.int64()), pa.array(cls, pa.int64()), pa.array(central, pa.int32()), lists],
                ["id", "n", "cls", "central", "prefix"],
            )

    kind = dict(slim.dtypes)["id"]
    return slim.mapInArrow(run, f"id {kind}, n long, cls long, central int, prefix array<long>")


def _class_sets(slim: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(id, cls, tokens) for the rows in ``wanted`` (cls, rep), and some others, read from their texts.

    Texts do not move: a bitmap of ``SLOTS`` bits of the wanted ids' hashes, the same
    size for any input, says which rows are worth reading.
    """
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(SLOTS)).cast("int")
    marked = np.zeros(SLOTS, dtype=bool)
    marked[wanted.select(slot("rep").alias("slot")).distinct().toPandas()["slot"].to_numpy(dtype=np.int64)] = True
    shared = slim.sparkSession.sparkContext.broadcast(np.packbits(marked))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.unpackbits(shared.value).astype(bool)

        def kept() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(marked[batch.column("slot").to_numpy()]))

        for part, tokens, first in _sets(kept(), n):
            full = np.flatnonzero(np.diff(first))
            rows = [tokens[first[i] : first[i + 1]] for i in full]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id").take(pa.array(full)),
                    pa.array([_digest(r) for r in rows], pa.int64()),
                    pa.array([_pack(r) for r in rows], pa.binary()),
                ],
                ["id", "cls", "tokens"],
            )

    kind = dict(slim.dtypes)["id"]
    return slim.select("id", "text", slot("id").alias("slot")).mapInArrow(run, f"id {kind}, cls long, tokens binary")


def _pack(tokens: np.ndarray) -> bytes:
    """Sorted tokens as their upper 48 bits each."""
    return np.ascontiguousarray(tokens.view(np.uint8).reshape(-1, 8)[:, 2:]).tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // 6, 8), dtype=np.uint8)
    out[:, 2:] = np.frombuffer(packed, dtype=np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


def _open(slim: DataFrame, classes: DataFrame, candidates: DataFrame, members: DataFrame, n: int, percent: int) -> DataFrame:
    """Links (a, b) between queries and members of the groups that they may match.

    ``candidates`` (cls, comp, gid), ``members`` (gid, cls, comp). A query's overlap with
    the union of the group is counted first; the group is opened if it is large enough.
    One link is reported for each component of the group that is not the query's.
    """
    asked = candidates.select("cls", "comp", "gid", F.pmod(F.xxhash64("cls"), F.lit(1 << 20)).alias("h"))
    # Written, so that the joins with it can be split where one group has very many queries.
    chunks = write_through(asked.groupBy("gid").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("chunks")), "chunks")
    asked = asked.join(chunks, "gid").select("gid", F.pmod("h", "chunks").alias("chunk"), "cls", "comp", F.lit(True).alias("query"))
    held = (
        members.join(chunks, "gid")
        .select("gid", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "cls", "comp", F.lit(False).alias("query"))
    )
    rows = asked.select("gid", F.col("chunk").cast("int"), "cls", "comp", "query").unionByName(held)
    wanted = classes.join(candidates.select("cls").unionByName(members.select("cls")).distinct(), "cls").select("cls", "rep")
    wanted = write_through(wanted, "wanted")
    sets = _class_sets(slim, wanted, n).withColumnRenamed("id", "rep")
    rows = rows.join(wanted, "cls").join(sets, ["cls", "rep"]).select("gid", "chunk", "cls", "comp", "query", "tokens")

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates(["query", "cls"])
        queries, group = rows[rows["query"]], rows[~rows["query"]].sort_values("cls")
        sets = [_unpack(t) for t in group["tokens"]]
        if not sets or not len(queries):
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        sizes = np.array([len(s) for s in sets])
        tokens = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), sizes)
        by = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[by], owner[by]
        cls, comp = group["cls"].to_numpy(), group["comp"].to_numpy()
        out = []
        for q, own, t in zip(queries["cls"], queries["comp"], queries["tokens"]):
            query = _unpack(t)
            lo, hi = np.searchsorted(tokens, query), np.searchsorted(tokens, query, side="right")
            if 100 * np.count_nonzero(hi > lo) < percent * len(query):
                continue
            many = hi - lo
            at = np.repeat(lo, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            both = np.bincount(owner[at], minlength=len(sets))
            good = np.flatnonzero((100 * both >= percent * (len(query) + sizes - both)) & (comp != own))
            _, one = np.unique(comp[good], return_index=True)
            out += [(q, x) for x in cls[good[one]]]
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return rows.groupBy("gid", "chunk").applyInPandas(compare, "a long, b long")


def _heads(shared: DataFrame) -> DataFrame:
    """(t, head, head_n): the most central class of each token.

    Copies of a text that many were made from are alike in ``central``: of these, the one
    whose tokens are in the most rows is least edited. Ties end at the number of the class,
    so that the tokens of a family choose the same head, in whatever order their rows meet.
    """
    weight = write_through(
        shared.groupBy("cls").agg(F.max("central").alias("central"), F.sum("rows").alias("mass"), F.max("copies").alias("copies")),
        "weights",
    )
    order = F.struct("central", "mass", "copies", "cls")
    heads = shared.select("t", "cls", "n").join(weight, "cls").groupBy("t").agg(F.max(F.struct(order.alias("by"), "n")).alias("top"))
    return heads.select("t", F.col("top.by.cls").alias("head"), F.col("top.n").alias("head_n"))


def _need(n: Column, m: Column, percent: int) -> Column:
    """Tokens that sets of ``n`` and ``m`` must share at least."""
    return F.ceil((n + m) * percent / (100 + percent))


def _may_meet(percent: int) -> Column:
    """Whether a shared token can be one of the first that a query and a member share.

    Of sets of n and m tokens that share a tokens, one shared token is among the first
    n - a + 1 of the one and m - a + 1 of the other, so later ones need not be looked
    at. A query of ``n`` tokens has the token at ``place``, the members of a group have
    ``least`` to ``most`` tokens, and the token at ``g_first`` or later.
    """
    n = F.col("n")
    low = F.greatest(F.col("least"), F.ceil(n * percent / 100))
    high = F.least(F.col("most"), F.floor(n * 100 / percent))
    return (
        (low <= high)
        & (F.col("place") + _need(n, low, percent) <= n)
        & (F.col("g_first") + _need(n, high, percent) <= high)
    )


def _may_match(percent: int) -> Column:
    """Whether a query of ``n`` tokens may match a group's member, by the tokens they met at.

    For a group of one member (``alone``), all that both share beyond the ``k`` tokens they
    met at comes after the last of these, at ``place`` and ``g_place`` of the two.
    """
    n, m = F.col("n"), F.col("most")
    after = F.least(n - F.col("place"), m - F.col("g_place")) - 1
    return ~F.col("alone") | (F.col("k") + after >= _need(n, m, percent))


def similar_documents(
    docs: DataFrame, n: int = 5, percent: int = 80, text: str = "text", id: str = "doc_id"
) -> DataFrame:
    """(id, n_shingles, component_id) for every row of ``docs``.

    A row's set are the distinct runs of ``n`` words, lower-cased for A-Z; of fewer words
    the whole sequence is the only one. Two rows are linked if 100 * intersection >=
    ``percent`` * union; ``component_id`` is the smallest id reachable by links. Rows
    without words, null or empty, have size 0 and are linked with nothing; so are rows
    without an id, whose component is null. Rows with equal sets are linked, repeated
    rows too. Columns of other names are ignored. An empty table gives no rows.

    Tokens are 64-bit hashes of n-grams, compared by 48 bits where two sets meet; classes
    are known by a 64-bit digest. No link is lost: candidates come from exact bounds.
    """
    slim = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    order = Order(_frequent(slim, n, percent))
    signed = write_through(_signatures(slim, n, percent, order), "signatures")
    known = signed.filter("cls IS NOT NULL AND id IS NOT NULL")
    classes = write_through(
        known.groupBy("cls").agg(F.min("id").alias("rep"), F.max("n").alias("n")), "classes"
    )
    tokens = known.select("cls", "n", "central", F.posexplode("prefix").alias("place", "t"))
    met = tokens.groupBy("t").agg(F.min("cls").alias("a"), F.max("cls").alias("b"), F.count("*").alias("rows"))
    met = met.filter("a <> b").select("t", "rows")
    shared = write_through(
        tokens.join(met, "t").groupBy("cls", "n", "place", "t").agg(
            F.max("central").alias("central"), F.max("rows").alias("rows"), F.count("*").alias("copies")
        ),
        "shared-tokens",
    )
    shared, heads = shared.select("cls", "n", "place", "t"), _heads(shared)

    # Stars: each class against the most central class of its tokens.
    size = prefix_size(F.col("n"), percent)
    stars = (
        shared.join(heads, "t")
        .filter("cls <> head")
        .filter((F.col("head_n") * 100 >= F.col("n") * percent) & (F.col("head_n") * percent <= F.col("n") * 100))
        .groupBy("cls", "head", "n")
        .agg(F.count("*").alias("k"))
        .filter(F.col("k") * 100 >= FAMILY * size.cast("long"))
    )
    best = stars.groupBy("cls").agg(F.max_by("head", "k").alias("family"))
    asked = stars.select("cls", F.col("cls").alias("comp"), F.col("head").alias("gid"))
    asked = write_through(asked, "star-queries")
    heads_only = asked.select("gid").distinct().select("gid", F.col("gid").alias("cls"), F.col("gid").alias("comp"))
    first_links = write_through(_open(slim, classes, asked, heads_only, n, percent), "star-links")
    comps = write_through(components(first_links).withColumnRenamed("node", "cls"), "star-components")

    # Groups: classes of one family, linked to its head or not, in bounded parts.
    grouped = (
        classes.select("cls", "n")
        .join(best, "cls", "left")
        .join(comps, "cls", "left")
        .select(
            "cls",
            "n",
            F.coalesce("component", "cls").alias("comp"),
            F.coalesce("family", "cls").alias("family"),
            F.col("component").isNotNull().alias("linked"),
        )
        .withColumn("lot", F.when(F.col("linked"), F.col("comp")).otherwise(F.col("family")))
    )
    parts = grouped.groupBy("lot", "linked").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("parts"))
    grouped = grouped.join(parts, ["lot", "linked"]).select(
        "cls", "comp", "n", F.col("linked").alias("one"),
        F.xxhash64("lot", "linked", F.pmod(F.xxhash64("cls"), F.col("parts"))).alias("gid"),
    )
    grouped = write_through(grouped, "groups")
    rows = write_through(
        shared.select("t", "place", "cls").join(grouped, "cls").select("t", "place", "cls", "n", "comp", "gid", "one"),
        "matrix-rows",
    )
    apart = rows.groupBy("t").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).filter("a <> b").select("t")
    rows = rows.join(apart, "t", "left_semi")
    matrix = rows.groupBy("t", "gid", "one").agg(
        F.count("*").alias("held"), F.min("place").alias("g_first"), F.max("place").alias("g_place"),
        F.min("comp").alias("any"), F.min("n").alias("least"), F.max("n").alias("most"),
    )
    matrix = matrix.select(
        "t", F.col("gid").alias("g"), F.col("one").alias("g_one"), "held", "g_first", "g_place", "any", "least", "most"
    )
    # Each pair of groups meets once: unlinked classes ask linked groups, else the smaller number asks.
    asks = (
        ((~F.col("one")) & F.col("g_one"))
        | ((F.col("one") == F.col("g_one")) & (F.col("gid") < F.col("g")))
        | ((F.col("gid") == F.col("g")) & ~F.col("one") & (F.col("held") > 1))
    )
    met = (
        rows.join(matrix, "t")
        .filter(asks & _may_meet(percent) & ~(F.col("g_one") & (F.col("any") == F.col("comp"))))
        .groupBy("cls", "n", "comp", "g")
        .agg(F.count("*").alias("k"), F.max("place").alias("place"), F.max("g_place").alias("g_place"))
    )
    spans = grouped.groupBy(F.col("gid").alias("g")).agg(
        F.min("n").alias("least"), F.max("n").alias("most"), (F.count("*") == 1).alias("alone")
    )
    asked = write_through(
        met.join(spans, "g")
        .filter(_may_match(percent))
        .select("cls", "comp", F.col("g").alias("gid")),
        "queries",
    )
    members = write_through(
        grouped.join(asked.select("gid").distinct(), "gid", "left_semi").select("gid", "cls", "comp"), "members"
    )
    links = _open(slim, classes, asked, members, n, percent)
    whole = components(first_links.unionByName(links))
    placed = signed.select("id", "n", "cls").join(whole.withColumnRenamed("node", "cls"), "cls", "left").select(
        "id", "n", F.coalesce("component", "cls").alias("root")
    )
    placed = write_through(placed, "placed")
    # A table of its own, so that a root with very many rows is split when it is joined.
    least = write_through(placed.filter("root IS NOT NULL").groupBy("root").agg(F.min("id").alias("least")), "least")
    return placed.join(least, "root", "left").select(
        F.col("id").alias(id),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("least", "id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80, text: str = "text", id: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, all columns, that stand for their component: one row of each, with its smallest id.

    Every row is judged by its own text: of rows that repeat an id, those of one component
    keep one row, those of others their own. Rows without an id are kept.
    """
    row = "_" * (1 + max(map(len, docs.columns)))
    numbered = write_through(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    key = F.struct(F.col(f"`{id}`").alias("id"), F.col(row).alias("row")).alias("key")
    named = numbered.filter(F.col(f"`{id}`").isNotNull()).select(key, F.col(f"`{text}`").alias("text"))
    found = similar_documents(named, n, percent, "text", "key")
    spare = found.filter("key <> component_id").select(F.col("key.row").alias(row))
    return numbered.join(spare, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
