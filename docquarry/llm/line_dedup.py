"""Line deduplication by content-defined line chunks (DataFrame functions only).

A text is split at newlines and each line is hashed. A rolling hash over the last two line hashes closes a
chunk where it is divisible by `divisor`, so boundaries depend on nearby lines only and fall at the same
places after text was inserted further up. A line of `long_words` words or more is a passage by itself: it
opens and closes its own chunk. A chunk is eligible when it is such a passage, or has several lines and
`min_words` words. Where an eligible chunk occurs more than once, the lines that a boundary cut off from
the repeated run are matched outwards too, up to the next repeated chunk on either side. Every occurrence
but the first (smallest document id, then line) is removed, once its bytes equal those of the first.

Boundaries may fall anywhere in a passage of few lines, so every run of lines with `long_words` words or more
is matched too, wherever chunks close: the shortest such runs from each line on and up to each line cover
each line of any longer one. An occurrence that overlaps the first of its run in one document stays. Only
lines that occur again can belong to a run; runs are hashed by differences of prefix sums, and walks end at the
first line that nobody shares, so the work is n log n in the lines of a document.

Line hashes, chunk table and neighbour matching hold no text: one narrow row a document, written once.
Text is moved twice, to read the bytes of repeated segments and to rebuild the documents. A line, chunk or run
that a large share of all rows hold isn't gathered in one task: hot keys are few and meet a broadcast table
(common.join_keys), and their bytes are compared over salted tasks.

Defined results: null text stays null and an empty text stays empty; rows with a null id pass unchanged;
equal rows of one id count as one document (a segment isn't a repetition of itself); texts are processed
whole, however many lines they have; of equal segments the first stays; different bytes under one hash are
kept; an empty table gives an empty one; other columns pass through, whatever their names, except that columns
named n_lines and n_removed are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docquarry.llm.common import HOT, cut, fresh, join_keys, let, only, passing, table

DIVISOR = 2
LONG_WORDS = 50
MIN_WORDS = 20
#: Copies of a segment whose bytes one task compares, where there are very many.
COPIES = 2_000
#: Bytes of removals that are broadcast to the texts, at most; beyond, both shuffle.
HELD = 32 << 20
#: Prime moduli and bases of the prefix sums.
MODULI = ((2_147_483_647, 1_000_003), (2_147_483_629, 998_244_353))


def _hash60(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def line_table(docs: DataFrame) -> DataFrame:
    """One row a document: id, line hashes h, words a line w."""
    lines = only(docs, "doc_id", "text").where("doc_id is not null and text is not null").select("doc_id", F.split("text", "\n").alias("lines"))
    return lines.select(
        "doc_id",
        F.transform("lines", lambda x: _hash60(x)).alias("h"),
        F.transform("lines", lambda x: F.regexp_count(x, F.lit("[^ ]+"))).alias("w"),
    ).distinct()


def _chunks(divisor: int, long_words: int) -> Column:
    """Array of (pos, len, words, key) for the arrays h and w of a document."""
    n = F.size("h")
    mod = lambda c: F.pmod(c, F.lit(1_000_003))
    at = lambda name, i: F.get(F.col(name), i)
    rolled = lambda i: F.pmod(mod(mod(at("h", i)) + 31 * mod(F.coalesce(at("h", i - 1), F.lit(0)))), F.lit(divisor))
    ends = F.filter(
        F.sequence(F.lit(0), n - 1),
        lambda i: (i == n - 1) | (at("w", i) >= long_words) | F.coalesce(at("w", i + 1) >= long_words, F.lit(False)) | (rolled(i) == 0),
    )
    spans = let(ends, lambda a: F.transform(a, lambda e, k: F.struct(F.when(k == 0, 0).otherwise(F.get(a, k - 1) + 1).alias("pos"), e.alias("last"))))
    return F.transform(
        spans,
        lambda s: F.struct(
            s["pos"].alias("pos"),
            (s["last"] - s["pos"] + 1).alias("len"),
            F.aggregate(F.slice("w", s["pos"] + 1, s["last"] - s["pos"] + 1), F.lit(0), lambda a, x: a + x).alias("words"),
            F.xxhash64(F.slice("h", s["pos"] + 1, s["last"] - s["pos"] + 1)).alias("key"),
        ),
    )


def _with_first(rows: DataFrame, total: int) -> DataFrame:
    """Rows (doc_id, pos, len, key) whose key has several places, with the first one. Counted with map-side
    minimums."""
    place = F.struct("doc_id", "pos")
    both = rows.groupBy("key").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.count(F.lit(1)).alias("n"))
    return join_keys(rows, cut(both.where(F.col("first") != F.col("last")).drop("last")), "key", total)


def _power(base: int, modulus: int, k: Column) -> Column:
    """base ** k, by tables of the powers of each of the five digits that k has to the base 128."""
    out = F.lit(1).cast("long")
    for d in range(5):
        digits = F.lit([pow(base, i * 128**d, modulus) for i in range(128)])
        out = F.pmod(out * F.get(digits, F.shiftright(k, 7 * d).bitwiseAND(F.lit(127)).cast("int")), F.lit(modulus))
    return out


def shared_lines(lines: DataFrame, total: int) -> DataFrame:
    """(doc_id, pos, h, w, streak, t0, s0, t1, s1) of the lines that occur again; neighbours have one streak.
    t is a line's part in the prefix sum s of its document."""
    line = lines.select("doc_id", F.posexplode(F.arrays_zip("h", "w")).alias("pos", "x")).select("doc_id", "pos", "x.*")
    again = cut(line.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    order = Window.partitionBy("doc_id").orderBy("pos")
    rows = join_keys(line, again, "h", total).withColumn("streak", F.col("pos") - F.row_number().over(order))
    for i, (modulus, base) in enumerate(MODULI):
        rows = rows.withColumn(f"t{i}", F.pmod(F.pmod("h", F.lit(modulus)) * _power(base, modulus, F.col("pos")), F.lit(modulus)))
    return rows.withColumns({f"s{i}": F.sum(f"t{i}").over(order) for i in range(len(MODULI))})


def _run_key(lo: Column, n: Column, sums: list[Column]) -> Column:
    """Key of a run of n lines from lo on, from the differences of the prefix sums at its ends: the same wherever
    the run stands."""
    parts = []
    for (modulus, base), s in zip(MODULI, sums, strict=True):
        parts.append(F.pmod(F.pmod(s, F.lit(modulus)) * _power(pow(base, -1, modulus), modulus, lo), F.lit(modulus)))
    return F.xxhash64(n, *parts)


def _grown(shared: DataFrame, found: DataFrame, total: int) -> DataFrame:
    """Places of lines beside repeated chunks that are repeated with them: walked away from each chunk, line by
    line, up to the next repeated chunk or the end of the streak."""
    none = lambda kind: F.lit(None).cast(kind)
    line = shared.select("doc_id", "pos", F.lit(1).alias("kind"), "h", none("int").alias("stop"), none("long").alias("key"))
    chunk = found.select("doc_id", "pos", F.lit(0).alias("kind"), none("long").alias("h"), (F.col("pos") + F.col("len")).alias("stop"), "key")
    document = Window.partitionBy("doc_id")
    order = document.orderBy("pos", "kind")
    rows = line.unionByName(chunk).withColumn("streak", F.col("pos") - F.sum("kind").over(order.rowsBetween(Window.unboundedPreceding, 0)) + F.col("kind"))
    mark = F.when(F.col("kind") == 0, F.struct("pos", "stop", "key", "streak"))
    rows = rows.withColumn("last", F.last(mark, True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("next", F.last(mark, True).over(document.orderBy(F.desc("pos"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, 0)))
    gap = rows.where("kind = 1 and (last is null or pos >= last.stop)")
    after = gap.where("last.streak = streak").select("doc_id", "pos", "h", F.lit("f").alias("way"), F.col("last.key").alias("chunk"), F.col("last.stop").alias("from"), (F.col("pos") - F.col("last.stop") + 1).alias("n"))
    before = gap.where("next.streak = streak").select("doc_id", "pos", "h", F.lit("b").alias("way"), F.col("next.key").alias("chunk"), F.col("next.pos").alias("from"), (F.col("next.pos") - F.col("pos")).alias("n"))
    # each line hashed with its distance: a sum that two walks share only if they passed the same lines
    stepped = F.sum(F.pmod(F.xxhash64("h", "n"), F.lit(1 << 40))).over(Window.partitionBy("doc_id", "way", "from").orderBy("n"))
    walked = after.unionByName(before).withColumn("run", stepped)
    near = cut(walked.select("doc_id", "pos", F.lit(1).alias("len"), F.xxhash64("way", "chunk", "n", "run", "h").alias("key")))
    return _with_first(near, total)


def _passages(shared: DataFrame, long_words: int, total: int) -> DataFrame:
    """Places of repeated runs of lines of long_words words or more: (key, doc_id, pos, len, first). Matched are
    the shortest runs from each line on and up to each line."""
    streak = Window.partitionBy("doc_id", "streak")
    within = shared.withColumn("upto", F.sum("w").over(streak.orderBy("pos"))).withColumn("all", F.sum("w").over(streak)).where(F.col("all") >= long_words)

    # Forward, the first line at which the words reach those before a line plus long_words; backward, the last
    # line before which there are long_words fewer than up to a line. Both by one running maximum.
    before = F.col("upto") - F.col("w")
    place = lambda at, *sums: F.struct(at.alias("at"), *(s.alias(f"s{i}") for i, s in enumerate(sums)))
    ends, starts = (F.col("s0"), F.col("s1")), (F.col("s0") - F.col("t0"), F.col("s1") - F.col("t1"))
    event = lambda way, rank, asks, best: F.struct(F.lit(way).alias("way"), rank.alias("rank"), F.lit(asks).alias("asks"), best.alias("best"))
    none = F.lit(None).cast("struct<at:int,s0:bigint,s1:bigint>")
    events = F.array(
        event("f", -F.col("upto"), 0, place(-F.col("pos"), *ends)), event("f", -before - long_words, 1, none),
        event("b", before, 0, place(F.col("pos"), *starts)), event("b", F.col("upto") - long_words, 1, none),
    )
    reached = F.max("best").over(Window.partitionBy("doc_id", "streak", "way").orderBy("rank", "asks").rowsBetween(Window.unboundedPreceding, 0))
    asked = within.select("doc_id", "streak", "pos", place(F.col("pos"), *ends).alias("end"), place(F.col("pos"), *starts).alias("start"), F.explode(events).alias("e"))
    asked = asked.select("doc_id", "streak", "pos", "end", "start", "e.*").withColumn("reached", reached).where("asks = 1 and reached is not null")
    forward = F.col("way") == "f"
    lo = F.when(forward, F.col("pos")).otherwise(F.col("reached.at"))
    hi = F.when(forward, -F.col("reached.at")).otherwise(F.col("pos"))
    spans = asked.select(
        "doc_id", lo.alias("pos"), (hi - lo + 1).alias("len"),
        *(F.when(forward, F.col(f"reached.s{i}") - F.col(f"start.s{i}")).otherwise(F.col(f"end.s{i}") - F.col(f"reached.s{i}")).alias(f"d{i}") for i in range(len(MODULI))),
    ).distinct()
    placed = cut(spans.select("doc_id", "pos", "len", _run_key(F.col("pos"), F.col("len"), [F.col(f"d{i}") for i in range(len(MODULI))]).alias("key")))
    found = _with_first(placed, total).where((F.col("doc_id") != F.col("first.doc_id")) | (F.col("pos") >= F.col("first.pos") + F.col("len")))

    # Overlapping runs that repeat the same place become one segment, so that its bytes are read once.
    found = found.select("doc_id", "pos", (F.col("pos") + F.col("len")).alias("stop"), F.col("first.doc_id").alias("of"), (F.col("pos") - F.col("first.pos")).alias("shift"))
    same = Window.partitionBy("doc_id", "of", "shift").orderBy("pos", "stop")
    new = F.coalesce(F.col("pos") > F.max("stop").over(same.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    found = found.withColumn("new", new).withColumn("part", F.sum(F.col("new").cast("int")).over(same.rowsBetween(Window.unboundedPreceding, 0)))
    found = found.groupBy("doc_id", "of", "shift", "part").agg(F.min("pos").alias("pos"), F.max("stop").alias("stop"))
    found = found.select("doc_id", "pos", (F.col("stop") - F.col("pos")).alias("len"), F.struct(F.col("of").alias("doc_id"), (F.col("pos") - F.col("shift")).alias("pos")).alias("first"))
    found = found.withColumn("key", F.xxhash64(F.lit("passage"), "first.doc_id", "first.pos", "len"))
    places = F.array(F.struct("doc_id", "pos"), F.col("first"))
    return found.select("key", "len", "first", F.explode(places).alias("at")).select("key", "at.*", "len", "first")


def segments(docs: DataFrame, divisor: int = DIVISOR, long_words: int = LONG_WORDS, min_words: int = MIN_WORDS) -> DataFrame:
    """Places of repeated segments by hash: (key, doc_id, pos, len, first)."""
    with passing(docs.sparkSession) as keep:
        lines = cut(line_table(docs))
        total = lines.agg(F.sum(F.size("h"))).first()[0] or 0
        spread = lines.select("doc_id", F.explode(_chunks(divisor, long_words)).alias("c")).select("doc_id", "c.*")
        eligible = cut(spread.where((F.col("len") > 1) & (F.col("words") >= min_words) | (F.col("words") >= long_words)).drop("words"))
        found = cut(_with_first(eligible, total))
        shared = cut(shared_lines(lines, total))
        columns = ("key", "doc_id", "pos", "len", "first")
        parts = (found, _grown(shared, found, total), _passages(shared, long_words, total))
        return keep(parts[0].select(*columns).unionByName(parts[1].select(*columns)).unionByName(parts[2].select(*columns)).distinct())


def removals(docs: DataFrame, **settings: int) -> DataFrame:
    """(doc_id, gone): the sorted line numbers to remove from each document that loses any, after the bytes
    of each repeated segment were compared with those of its first occurrence."""
    with passing(docs.sparkSession) as keep:
        placed = cut(segments(docs, **settings))
        counted = placed.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        # fewer than HOT keys; a first occurrence is read once for each COPIES others
        hot = counted.where((F.col("n") > COPIES) & (F.col("n") * HOT > placed.count())).select("key", F.ceil(F.col("n") / COPIES).cast("int").alias("salts"))
        salted = placed.join(F.broadcast(hot), "key", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
        is_first = (F.struct("doc_id", "pos") == F.col("first")).alias("is_first")
        wanted = salted.groupBy("doc_id").agg(F.collect_set(F.struct("key", "pos", "len", is_first, "salts")).alias("s"))
        text = only(docs, "doc_id", "text").where("doc_id is not null and text is not null")
        read = text.join(wanted, "doc_id").select("doc_id", F.split("text", "\n").alias("lines"), F.explode("s").alias("s"))
        read = cut(read.select("doc_id", "s.*", F.array_join(F.slice("lines", F.col("s.pos") + 1, F.col("s.len")), "\n").alias("bytes")))
        first = read.where("is_first").select("key", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("bytes").alias("first_bytes")).distinct()
        again = read.where("not is_first").withColumn("salt", F.pmod(F.xxhash64("doc_id", "pos"), F.col("salts")).cast("int"))
        again = again.join(first, ["key", "salt"]).where(F.col("bytes").eqNullSafe(F.col("first_bytes")))
        lost = again.groupBy("doc_id").agg(F.collect_set(F.struct("pos", "len")).alias("s"))
        gone = F.array_sort(F.array_distinct(F.flatten(F.transform("s", lambda x: F.sequence(x["pos"], x["pos"] + x["len"] - 1)))))
        return keep(lost.select("doc_id", gone.alias("gone")))


def line_dedup(docs: DataFrame, **settings: int) -> DataFrame:
    """All rows and columns of docs, with the repeated segments taken out of `text`; n_lines and n_removed
    are added."""
    docs = docs.drop("n_lines", "n_removed")
    id_, gone = fresh(docs, "id"), fresh(docs, "gone")
    cut_out = removals(docs, **settings).select(F.col("doc_id").alias(id_), F.col("gone").alias(gone))
    size = cut_out.agg(F.sum(F.size(gone) * 4 + 64)).first()[0] or 0
    cut_out = F.broadcast(cut_out) if size <= HELD else cut_out.hint("shuffle_merge")
    lines = F.split("text", "\n")
    kept = lambda a: F.array_except(F.sequence(F.lit(0), F.size(a) - 1), F.col(gone))
    rebuilt = let(lines, lambda a: F.array_join(F.transform(kept(a), lambda i: F.get(a, i)), "\n"))
    joined = docs.join(cut_out, F.col("doc_id") == F.col(id_), "left")
    return joined.withColumns(
        {
            "n_lines": F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long"),
            "n_removed": F.coalesce(F.size(gone), F.lit(0)).cast("long"),
            "text": F.when(F.col(gone).isNull() | F.col("text").isNull(), F.col("text")).otherwise(rebuilt),
        }
    ).drop(id_, gone)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


SQL = f"""
with lines as (
  select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as pos
  from documents where text is not null),
hashed as (
  select *, ('0x' || substr(md5(line), 1, 15))::bigint as h, len(list_filter(string_split(line, ' '), lambda x: x <> '')) as w from lines),
ended as (
  select *, w >= {LONG_WORDS} or lead(w, 1, {LONG_WORDS}) over d >= {LONG_WORDS}
    or ((h % 1000003 + 31 * (coalesce(lag(h) over d, 0) % 1000003)) % 1000003) % {DIVISOR} = 0 as ends
  from hashed window d as (partition by doc_id order by pos)),
numbered as (
  select *, coalesce(sum(ends::int) over (partition by doc_id order by pos rows between unbounded preceding and 1 preceding), 0) as c from ended),
chunks as (
  select doc_id, c, min(pos) as pos, count(*) as len, sum(w) as words, string_agg(line, chr(10) order by pos) as body
  from numbered group by doc_id, c),
eligible as (select * from chunks where len > 1 and words >= {MIN_WORDS} or words >= {LONG_WORDS}),
found as (
  select * from (select *, min((doc_id, pos)) over (partition by body) as first, max((doc_id, pos)) over (partition by body) as last from eligible)
  where first <> last),
marked as (
  select n.*, f.body, f.first from numbered n left join found f using (doc_id, c)),
gaps as (
  select *, last_value(body ignore nulls) over (partition by doc_id order by pos rows unbounded preceding) as chunk_b,
    last_value(case when body is not null then pos end ignore nulls) over (partition by doc_id order by pos rows unbounded preceding) as at_b,
    first_value(body ignore nulls) over (partition by doc_id order by pos rows between current row and unbounded following) as chunk_a,
    first_value(case when body is not null then pos end ignore nulls) over (partition by doc_id order by pos rows between current row and unbounded following) as at_a
  from marked),
walked as (
  select doc_id, pos, 'f' as way, chunk_b as chunk, string_agg(line, chr(10)) over (partition by doc_id, at_b order by pos) as run from gaps where body is null and at_b is not null
  union all
  select doc_id, pos, 'b', chunk_a, string_agg(line, chr(10)) over (partition by doc_id, at_a order by pos desc) from gaps where body is null and at_a is not null),
grown as (
  select doc_id, pos from (select *, min((doc_id, pos)) over (partition by way, chunk, run) as first from walked) where (doc_id, pos) <> first),
again as (
  select * from (
    select doc_id, pos, w, line, pos - row_number() over (partition by doc_id order by pos) as streak
    from (select *, count(*) over (partition by line) as n from hashed) where n > 1)),
words_upto as (select *, sum(w) over (partition by doc_id, streak order by pos) as upto from again),
runs as (
  select a.doc_id, a.pos as lo, min(b.pos) as hi from words_upto a join words_upto b on a.doc_id = b.doc_id and a.streak = b.streak and b.pos >= a.pos
    and b.upto - a.upto + a.w >= {LONG_WORDS} group by all
  union
  select b.doc_id, max(a.pos), b.pos from words_upto a join words_upto b on a.doc_id = b.doc_id and a.streak = b.streak and b.pos >= a.pos
    and b.upto - a.upto + a.w >= {LONG_WORDS} group by all),
run_texts as (
  select r.doc_id, r.lo, r.hi, string_agg(a.line, chr(10) order by a.pos) as run from runs r join again a on a.doc_id = r.doc_id and a.pos between r.lo and r.hi group by all),
passages as (
  select doc_id, unnest(range(lo, hi + 1)) as pos from (select *, min((doc_id, lo)) over (partition by run) as first from run_texts)
  where doc_id <> first[1] or lo > first[2] + hi - lo),
gone as (
  select doc_id, pos from marked join (select doc_id, c from found where (doc_id, pos) <> first) using (doc_id, c)
  union select doc_id, pos from grown union select doc_id, pos from passages),
rebuilt as (
  select n.doc_id, count(*) as n_lines, count(g.pos) as n_removed,
    coalesce(string_agg(n.line, chr(10) order by n.pos) filter (g.pos is null), '') as text
  from numbered n left join gone g using (doc_id, pos) group by n.doc_id)
select d.doc_id, r.text, coalesce(r.n_lines, 0) as n_lines, coalesce(r.n_removed, 0) as n_removed from documents d left join rebuilt r using (doc_id)
"""
