"""Token counts that follow edits.

A text is cut at places where a pre-token must begin whatever stands around: a space between two characters
that are no white space. Token counts of the pieces add up to that of the text. They are the leaves of a
segment tree per document (two sums per node: characters and tokens). An edit finds its leaves by descending
on character sums; only these leaves, and a neighbour as context where an edge is no longer a safe cut, are
encoded again; sums above them are updated on the way to the root.

Trees are stored between runs as a table (`plant`): a row per document with its text and, leaf by leaf, characters and
tokens. `edited` takes such rows and changes to them and gives the counts and the changed rows, which can be stored
and edited again: what no edit touches is encoded once, when its document is planted. Rows without edits need not be
read through it; join changes to the stored trees by doc_id and pass the rows that have some. A leaf is split or joined
with its neighbours only inside the region of an edit; the sums are laid out anew when a region has outgrown its leaves
`WIDEST` times, so often at most as text of that size is put in.

Null texts are empty: 0 tokens. Edits are (start, end, replacement) in code points, applied one after the other, each
on the text as it then is; places beyond the end count as the end, null replacements are empty. Documents without
edits (null or an empty array) keep their counts. Equal rows get equal counts; an empty table gives no rows. Extra columns of
documents are ignored. A text without safe cuts is one leaf, however long, so every edit encodes all of it.
"""

import base64
import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from tarmac.llm.common import column, pieces, stored

#: Fixed value: the pattern of the public byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_CUT = re.compile(r"(?<=\S) (?=\S)")
LEAF = 64
#: Characters a leaf may grow to by edits before the sums are laid out anew, and fields of a stored tree.
WIDEST = 16 * LEAF
TREE = "text string, sizes array<bigint>, tokens array<bigint>"
REMEMBERED = 200_000


def encoder(path):
    """Token counter of a rank file, remembering the counts of pieces it has seen."""
    import tiktoken
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    known = {}

    def count(piece):
        n = known.get(piece)
        if n is None:
            if len(known) >= REMEMBERED:
                known.clear()
            n = known[piece] = len(own.encode_ordinary(piece))
        return n

    return count


def cuts(text):
    """The text in pieces, each beginning at its start or at a safe cut."""
    places = [0, *[m.start() for m in _CUT.finditer(text)], len(text)]
    return [text[a:b] for a, b in zip(places, places[1:]) if b > a]


class Tree:
    """Leaves of some `LEAF` characters, with sums of characters and tokens above them."""

    def __init__(self, text, count):
        self.count, self.encoded = count, 0
        self.build(self.leaves(text))

    @classmethod
    def of(cls, text, sizes, tokens, count):
        """A stored tree: nothing is encoded."""
        tree, start, leaves = cls("", count), 0, []
        for size, n in zip(sizes, tokens):
            leaves.append((text[start:start + size], n))
            start += size
        tree.build(leaves)
        return tree

    def stored(self):
        """Text, characters and tokens of each leaf."""
        kept = [(len(t), self.tokens[self.size + i]) for i, t in enumerate(self.texts) if t]
        return self.text(), [size for size, _ in kept], [n for _, n in kept]

    def leaves(self, text):
        out, some, size, tokens = [], [], 0, 0
        for piece in cuts(text):
            some.append(piece)
            size += len(piece)
            tokens += self.count(piece)
            if size >= LEAF:
                out.append(("".join(some), tokens))
                some, size, tokens = [], 0, 0
        if some:
            out.append(("".join(some), tokens))
        self.encoded += len(text)
        return out

    def build(self, leaves):
        self.texts = [t for t, _ in leaves]
        self.size = 1
        while self.size < max(1, len(leaves)):
            self.size *= 2
        self.chars, self.tokens = [0] * (2 * self.size), [0] * (2 * self.size)
        for i, (t, n) in enumerate(leaves):
            self.chars[self.size + i], self.tokens[self.size + i] = len(t), n
        for i in range(self.size - 1, 0, -1):
            self.update(i)

    def update(self, i):
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def find(self, place):
        """Leaf that holds a character, and the number of characters before the leaf."""
        i, before = 1, 0
        while i < self.size:
            i *= 2
            if place >= before + self.chars[i]:
                before += self.chars[i]
                i += 1
        return min(i - self.size, len(self.texts) - 1), before

    def edit(self, start, end, new):
        total = self.chars[1]
        start = min(max(start, 0), total)
        end = min(max(end, start), total)
        if not self.texts:
            return self.build(self.leaves(new))
        first, before = self.find(min(start, total - 1))
        last, before_last = self.find(max(end - 1, start) if total > start else total - 1)
        last = max(first, last)
        before = sum(self.chars[self.size:self.size + first]) if start >= total else before
        old = "".join(self.texts[first:last + 1])
        middle = old[:start - before] + new + old[end - before:]
        # Context: as long as an edge is no safe cut, the neighbour is encoded again as well.
        while first > 0 and not self.safe(self.texts[first - 1], middle):
            first -= 1
            middle = self.texts[first] + middle
        while last + 1 < len(self.texts) and not self.safe(middle, self.texts[last + 1]):
            last += 1
            middle += self.texts[last]
        fresh, room = self.leaves(middle), last - first + 1
        if len(fresh) > room and len(middle) > WIDEST * room:
            kept = [(t, self.tokens[self.size + i]) for i, t in enumerate(self.texts)]
            return self.build(kept[:first] + fresh + kept[last + 1:])
        some = -(-len(fresh) // room) or 1
        for i in range(room):
            joined = fresh[i * some:(i + 1) * some]
            self.texts[first + i] = "".join(t for t, _ in joined)
            k = self.size + first + i
            self.chars[k], self.tokens[k] = len(self.texts[first + i]), sum(n for _, n in joined)
            while k > 1:
                k //= 2
                self.update(k)

    @staticmethod
    def safe(left, right):
        return (len(left) > 0 and not left[-1].isspace() and len(right) > 1 and right[0] == " "
                and not right[1].isspace())

    def text(self):
        return "".join(self.texts)


def plant(documents, vocabulary, edits=None):
    """Stored trees: (doc_id, text, sizes, tokens) of every document, and `edits` of it if such a column is given."""
    def scan(batches):
        counter = encoder(vocabulary)
        for batch in batches:
            for part in pieces(batch):
                texts = pc.fill_null(part.column("text"), "")
                trees = [Tree(text, counter).stored()[1:] for text in texts.to_pylist()]
                at = part.schema.get_field_index("text")
                arrays = [*part.columns[:at], texts, *part.columns[at + 1:],
                          pa.array([sizes for sizes, _ in trees], pa.list_(pa.int64())),
                          pa.array([tokens for _, tokens in trees], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(arrays, names=[*part.schema.names, "sizes", "tokens"])

    df = documents.select(column("doc_id"), *([] if edits is None else [edits.alias("edits")]),
                          column("text").alias("text"))
    kept = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in df.schema.fields if f.name != "text")
    return stored(df.mapInArrow(scan, kept + TREE), "trees")


def edited(trees, vocabulary, keep=True):
    """(doc_id, n_tokens, n_edits, n_tokens_after, n_chars_after, n_encoded) of stored trees with a column `edits`, and with
    `keep` the trees after the edits (text, sizes, tokens).

    `edits` is an array of structs (start, end, replacement); `n_encoded` is the number of characters encoded again.
    """
    counts = ["n_tokens", "n_edits", "n_tokens_after", "n_chars_after", "n_encoded"]

    def scan(batches):
        counter = encoder(vocabulary)
        for batch in batches:
            for part in pieces(batch):
                rows, after = {name: [] for name in counts}, []
                for text, sizes, tokens, changes in zip(*[part.column(c).to_pylist()
                                                          for c in ("text", "sizes", "tokens", "edits")]):
                    tree = Tree.of(text, sizes, tokens, counter)
                    before = tree.tokens[1]
                    for change in changes or ():
                        tree.edit(change["start"], change["end"], change["replacement"] or "")
                    for name, n in zip(counts, (before, len(changes or ()), tree.tokens[1], tree.chars[1], tree.encoded)):
                        rows[name].append(n)
                    if keep:
                        after.append(tree.stored())
                arrays = [part.column("doc_id")] + [pa.array(v, pa.int64()) for v in rows.values()]
                if keep:
                    kinds = (pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()))
                    arrays += [pa.array([tree[k] for tree in after], kind) for k, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(
                    arrays, names=["doc_id", *counts, *(["text", "sizes", "tokens"] if keep else [])])

    df = trees.select("doc_id", "edits", "text", "sizes", "tokens")
    kind = df.schema["doc_id"].dataType.simpleString()
    return df.mapInArrow(scan, f"doc_id {kind}, " + ", ".join(f"{name} long" for name in counts)
                         + (f", {TREE}" if keep else ""))


def count(documents, edits, vocabulary):
    """Counts of every document before and after the edits that the column expression `edits` draws from it: its tree is
    stored first and edited as stored."""
    return edited(plant(documents, vocabulary, edits), vocabulary, keep=False)


def heading_edits(text="text"):
    """Edits drawn from a text itself: its first word goes, its first line is repeated at the end."""
    body = F.coalesce(column(text), F.lit(""))
    head = F.substring_index(body, "\n", 1)
    word = F.length(F.regexp_extract(body, r"^\S*\s?", 0))
    return F.array(
        F.struct(F.lit(0).alias("start"), word.alias("end"), F.lit("").alias("replacement")),
        F.struct((F.length(body) - word).alias("start"), (F.length(body) - word).alias("end"),
                 F.concat(F.lit("\n"), head).alias("replacement")))
