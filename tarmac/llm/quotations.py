"""Quotation linking: conversations in reply order, without quotes.

* Messages carry earlier ones as quoted lines (`>`, nested: the level is the number of marks). Lines of one level that follow
  each other are a run; blank lines cut a run into paragraphs. Runs, paragraphs and single lines are passages: normalised
  (white space, letter case) and hashed to 128 bits. The same is done with the unquoted lines of every message.
* Quoted passages of every level meet unquoted ones of the same thread and hash. Of several originals the latest turn before
  the quoting one counts: passages are sorted by (thread and hash, turn) in ranges, each range carries on the last original
  of the one before, so a phrase that fills a thread is no task's burden.
* A quoted line belongs to the widest passage found around it. Lines that belong to one leave the text, with the blank
  quoted lines of their run; quoted lines found nowhere stay. A message replies to the latest turn it quotes at
  level 1 (else at the lowest level it quotes); all its links are kept.
* Root and depth come from joining parents to parents, each join doubling the distance. A conversation is a root and what
  hangs on it, ordered by depth, turn and row, so a message always stands after the one it answers.

Null texts are empty and reply to nothing. A null thread is a thread of its own; rows without a turn keep their text whole, link
to nothing and are not linked to. Rows of equal thread and turn stay rows of their own, neither quotes the other. An empty table gives
no rows. Extra columns are ignored.
"""

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from tarmac.llm.common import column, stored
from tarmac.llm.places import placed, runs, sorted_rows

_MARKS = re.compile(r"^(?:> ?)+")
QUOTED, ORIGINAL = 0, 1


def lines_of(text):
    """(level, content) of each line."""
    out = []
    for line in (text or "").split("\n"):
        marks = _MARKS.match(line)
        out.append((marks.group().count(">"), line[marks.end():]) if marks else (0, line))
    return out


def passages(lines):
    """(first, last, level, normalised text) of all runs, paragraphs and lines, widest first; the last line is included."""
    out = []
    first = 0
    while first < len(lines):
        level, last = lines[first][0], first
        while last + 1 < len(lines) and lines[last + 1][0] == level:
            last += 1
        out.append((first, last, level))
        a = first
        for b in range(first, last + 2):
            if b > last or not lines[b][1].strip():
                if b > a and (a, b - 1) != (first, last):
                    out.append((a, b - 1, level))
                a = b + 1
        out += [(i, i, level) for i in range(first, last + 1) if first < last]
        first = last + 1
    own = [content for level, content in lines if level == 0]
    found = [(a, b, level, " ".join(" ".join(c for _, c in lines[a:b + 1]).lower().split())) for a, b, level in out]
    if any(level for level, _ in lines):  # what is left of a message with quotes is quoted as one
        found.append((0, len(lines) - 1, 0, " ".join(" ".join(own).lower().split())))
    return sorted({f for f in found if f[3]}, key=lambda f: (f[0] - f[1], f))


def _key(thread, passage):
    return hashlib.blake2b(repr((thread, passage)).encode("utf-8", "surrogatepass"), digest_size=16).digest()


_UNITS = "key binary, turn long, kind int, row long, first int, last int, level int"


def _units(batches):
    for batch in batches:
        out = [[] for _ in range(7)]
        for row, thread, turn, text in zip(*(batch.column(c).to_pylist() for c in ("row", "thread", "turn", "text"))):
            if turn is not None:
                seen = set()
                for first, last, level, passage in passages(lines_of(text)):
                    kind = QUOTED if level else ORIGINAL
                    if kind == ORIGINAL and passage in seen:
                        continue
                    seen.add(passage if kind == ORIGINAL else None)
                    for values, value in zip(out, (_key(thread, passage), turn, kind, row, first, last, level)):
                        values.append(value)
        kinds = [pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, kinds)],
                                         names=[c.split()[0] for c in _UNITS.split(", ")])


def links(units):
    """(row, first, last, level, to_turn, to_row) of every quoted passage that stands in an earlier message."""
    rows = sorted_rows(units, "key", ["turn", "kind", "row", "first", "last"])
    original = F.when(F.col("kind") == ORIGINAL, F.struct(F.col("turn").alias("to_turn"), F.col("row").alias("to_row")))
    rows = rows.withColumns({"original": original, "range": F.shiftright("at", 33)})
    within = Window.partitionBy("key", "range").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    near = rows.withColumn("near", F.last("original", ignorenulls=True).over(within))
    ends = rows.groupBy("key", "range").agg(F.max_by("original", F.when(F.col("kind") == ORIGINAL, F.col("at"))).alias("end"))
    earlier = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(F.col("key").alias("k"), F.col("range").alias("r"),
                          F.last("end", ignorenulls=True).over(earlier).alias("carried")).where("carried is not null")
    quoted = near.where(F.col("kind") == QUOTED).join(
        carried, (F.col("key") == F.col("k")) & (F.col("range") == F.col("r")), "left")
    return quoted.withColumn("to", F.coalesce("near", "carried")).where("to is not null").select(
        "row", "first", "last", "level", "to.to_turn", "to.to_row")


def unquoted(text, found):
    """The text without the passages found, and the links (level, turn, row) of its quoted lines."""
    lines = lines_of(text)
    owner = [None] * len(lines)
    for first, last, level, turn, row in sorted(found, key=lambda f: (f[0] - f[1], f)):
        for i in range(first, last + 1):
            if owner[i] is None and lines[i][0] == level:
                owner[i] = (level, turn, row)
    first = 0
    gone = [o is not None for o in owner]
    while first < len(lines):
        last = first
        while last + 1 < len(lines) and lines[last + 1][0] == lines[first][0]:
            last += 1
        if lines[first][0] and any(owner[first:last + 1]):
            for i in range(first, last + 1):
                gone[i] = gone[i] or not lines[i][1].strip()
        first = last + 1
    whole = (text or "").split("\n")
    return "\n".join(w for w, g in zip(whole, gone) if not g), sorted({o for o in owner if o}), max(
        level for level, _ in lines)


_LINKED = ("row long, thread {thread}, turn long, role string, text string, levels long, parent long, parent_row long, "
           "quotes array<struct<level:int,turn:long>>")


def _rewritten(batches):
    quotes = pa.list_(pa.struct([("level", pa.int32()), ("turn", pa.int64())]))
    for batch in batches:
        texts, levels, parents, parent_rows, all_links = [], [], [], [], []
        for text, found in zip(batch.column("text").to_pylist(), batch.column("found").to_pylist()):
            found = [(f["first"], f["last"], f["level"], f["to_turn"], f["to_row"]) for f in found or []]
            text, linked, deepest = unquoted(text, found)
            nearest = min((level for level, _, _ in linked), default=None)
            parent = max(((turn, row) for level, turn, row in linked if level == nearest), default=(None, None))
            texts.append(text)
            levels.append(deepest)
            parents.append(parent[0])
            parent_rows.append(parent[1])
            all_links.append([{"level": a, "turn": b} for a, b in sorted({(a, b) for a, b, _ in linked})])
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("row", "thread", "turn", "role")] + [
                pa.array(texts, pa.string()), pa.array(levels, pa.int64()), pa.array(parents, pa.int64()),
                pa.array(parent_rows, pa.int64()), pa.array(all_links, quotes)],
            names=["row", "thread", "turn", "role", "text", "levels", "parent", "parent_row", "quotes"])


def rooted(parents):
    """(row, root, depth) from (row, up): the parent's row, null for roots. A parent is always an earlier message.

    Each round doubles how far a row sees; rows that have seen their root are joined no more.
    """
    state = stored(parents.select("row", F.coalesce("up", "row").alias("root"),
                                  F.when(F.col("up").isNull(), 0).otherwise(1).cast("long").alias("depth"),
                                  F.col("up").isNull().alias("done")), "parents")
    while not state.where("not done").isEmpty():
        above = state.select(F.col("row").alias("r"), F.col("root").alias("higher"), F.col("depth").alias("more"),
                             F.col("done").alias("seen"))
        further = state.where("not done").join(above, F.col("root") == F.col("r")).select(
            "row", F.col("higher").alias("root"), (F.col("depth") + F.col("more")).alias("depth"), F.col("seen").alias("done"))
        state = stored(state.where("done").unionByName(further), "parents")
    return state.select("row", "root", "depth")


def conversations(messages):
    """(thread, turn, role, text, parent, root, depth, place, levels, quotes) of every message.

    `parent` and `root` are turns, `place` counts from 1 in the conversation, `levels` is the deepest quote, `quotes` are
    the (level, turn) it quotes.
    """
    rows = stored(messages.select(
        F.monotonically_increasing_id().alias("row"), column("thread").alias("thread"),
        column("turn").cast("long").alias("turn"), column("role").cast("string").alias("role"),
        column("text").alias("text")), "messages")
    units = stored(rows.select("row", "thread", "turn", "text").mapInArrow(_units, _UNITS), "passages")
    found = links(units).groupBy(
        F.col("row").alias("of")).agg(F.collect_list(F.struct("first", "last", "level", "to_turn", "to_row")).alias("found"))
    shape = _LINKED.format(thread=rows.schema["thread"].dataType.simpleString())
    linked = stored(rows.join(found, F.col("row") == F.col("of"), "left").drop("of").mapInArrow(_rewritten, shape), "linked")
    tree = rooted(linked.select("row", F.col("parent_row").alias("up"))).select(
        F.col("row").alias("of"), F.col("root").alias("root_row"), "depth")
    turns = linked.select(F.col("row").alias("top"), F.col("turn").alias("root"))
    ordered = sorted_rows(linked.select("row", "turn").join(tree, F.col("row") == F.col("of")).join(
        turns, F.col("root_row") == F.col("top")).drop("of", "top"), "root_row", ["depth", "turn", "row"])
    ranked = placed(ordered, runs(ordered, "root_row"), "root_row").select(
        F.col("row").alias("of"), "root", "depth", (F.col("idx") + 1).cast("long").alias("place"))
    return linked.join(ranked, F.col("row") == F.col("of")).select(
        "thread", "turn", "role", "text", "parent", "root", "depth", "place", "levels", "quotes")


def digest(conversations_):
    """The same with the quotes as text (`level:turn`, comma-joined)."""
    quotes = F.array_join(F.transform("quotes", lambda q: F.concat_ws(":", q["level"], q["turn"])), ",")
    return conversations_.withColumn("quotes", quotes)


def quoting(conversations_, window=2):
    """Messages as a mail program would send them: each turn quotes the one before, which quotes its own."""
    order = Window.partitionBy("conv_id").orderBy("turn", "text")
    df = conversations_.withColumns({f"back{k}": F.lag("text", k).over(order) for k in range(1, window + 1)})

    def quoted(text, level):
        mark = "> " * level
        return F.array_join(F.transform(F.split(text, "\n"), lambda x: F.concat(F.lit(mark), x)), "\n")

    parts = [quoted(F.col(f"back{k}"), k) for k in range(window, 0, -1)]
    return df.select(F.col("conv_id").alias("thread"), "turn", "role",
                     F.concat_ws("\n", *parts, F.coalesce("text", F.lit(""))).alias("text"))


def brute_force(messages):
    """In plain Python, for rows (thread, turn, role, text): the rows of `conversations`, every pair of messages compared."""
    out = []
    parsed = [(lines_of(text), passages(lines_of(text))) for _, _, _, text in messages]
    parents = {}
    for n, (thread, turn, role, text) in enumerate(messages):
        found = []
        for first, last, level, passage in parsed[n][1]:
            if level and turn is not None:
                same = [(m[1], k) for k, m in enumerate(messages) if m[0] == thread and m[1] is not None and m[1] < turn
                        and any(p[2] == 0 and p[3] == passage for p in parsed[k][1])]
                if same:
                    found.append((first, last, level, *max(same)))
        text, linked, deepest = unquoted(text, found)
        low = min((x[0] for x in linked), default=None)
        parents[n] = max(((x[1], x[2]) for x in linked if x[0] == low), default=(None, None))
        out.append([thread, turn, role, text, parents[n][0], deepest, sorted({x[:2] for x in linked})])
    depth, root = {}, {}
    for n in range(len(messages)):
        at, steps = n, 0
        while parents[at][1] is not None:
            at, steps = parents[at][1], steps + 1
        depth[n], root[n] = steps, at
    for n in range(len(messages)):
        def order(k):
            return depth[k], (messages[k][1] is not None, messages[k][1] or 0), k
        place = 1 + sum(order(k) < order(n) for k in range(len(messages)) if root[k] == root[n])
        thread, turn, role, text, parent, deepest, quotes = out[n]
        out[n] = (thread, turn, role, text, parent, messages[root[n]][1], depth[n], place, deepest, quotes)
    return out


#: DuckDB SQL for the query on messages made by `quoting`: quoted lines are parsed out of the texts again.
ORACLE_SQL = r"""
WITH RECURSIVE ordered AS (
  SELECT conv_id AS thread, turn, role, coalesce(text, '') AS own,
         lag(text, 1) OVER w AS back1, lag(text, 2) OVER w AS back2
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, text)),
sent AS (
  SELECT thread, turn, role, concat_ws(chr(10),
    array_to_string(list_transform(string_split(back2, chr(10)), lambda x: '> > ' || x), chr(10)),
    array_to_string(list_transform(string_split(back1, chr(10)), lambda x: '> ' || x), chr(10)), own) AS text
  FROM ordered),
lines AS (
  SELECT thread, turn, i, parts[i] AS line,
         length(replace(regexp_extract(parts[i], '^((?:> ?)*)', 1), ' ', '')) AS level,
         regexp_replace(parts[i], '^(?:> ?)*', '') AS content
  FROM (SELECT thread, turn, string_split(text, chr(10)) AS parts FROM sent) s, LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS i) t),
marked AS (SELECT *, sum(CASE WHEN level = before THEN 0 ELSE 1 END) OVER (PARTITION BY thread, turn ORDER BY i) AS run
  FROM (SELECT *, lag(level) OVER (PARTITION BY thread, turn ORDER BY i) AS before FROM lines)),
grains AS (
  SELECT thread, turn, level, run, NULL::BIGINT AS i, string_agg(content, ' ' ORDER BY i) AS words FROM marked GROUP BY thread, turn, level, run
  UNION ALL SELECT thread, turn, level, run, i, content FROM marked),
passages AS (SELECT * EXCLUDE (words), trim(regexp_replace(lower(words), '\s+', ' ', 'g')) AS words FROM grains),
originals AS (SELECT DISTINCT thread, turn, words FROM passages WHERE level = 0 AND words <> ''),
found AS (
  SELECT q.thread, q.turn, q.level, q.run, q.i, max(o.turn) AS target
  FROM passages q JOIN originals o ON o.thread = q.thread AND o.words = q.words AND o.turn < q.turn
  WHERE q.level > 0 GROUP BY ALL),
owned AS (
  SELECT m.thread, m.turn, m.i, m.line, m.level, m.run, trim(m.content) = '' AS blank, coalesce(r.target, l.target) AS target
  FROM marked m LEFT JOIN found r ON r.thread = m.thread AND r.turn = m.turn AND r.run = m.run AND r.i IS NULL
       LEFT JOIN found l ON l.thread = m.thread AND l.turn = m.turn AND l.run = m.run AND l.i = m.i),
judged AS (SELECT *, target IS NOT NULL OR (blank AND level > 0 AND max(target) OVER (PARTITION BY thread, turn, run) IS NOT NULL) AS gone FROM owned),
messages AS (
  SELECT thread, turn, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS text, max(level) AS levels,
         arg_min(target, level * 1000000000 - target) FILTER (WHERE target IS NOT NULL) AS parent,
         coalesce(string_agg(DISTINCT level || ':' || target, ',' ORDER BY level || ':' || target) FILTER (WHERE target IS NOT NULL), '') AS quotes
  FROM judged GROUP BY thread, turn),
tree AS (
  SELECT thread, turn, turn AS root, 0 AS depth FROM messages WHERE parent IS NULL
  UNION ALL SELECT m.thread, m.turn, t.root, t.depth + 1 FROM messages m JOIN tree t ON t.thread = m.thread AND t.turn = m.parent)
SELECT m.thread, m.turn, s.role, m.text, m.parent, t.root, t.depth::BIGINT AS depth,
       row_number() OVER (PARTITION BY m.thread, t.root ORDER BY t.depth, m.turn) AS place, m.levels, m.quotes
FROM messages m JOIN sent s USING (thread, turn) JOIN tree t USING (thread, turn)
"""
