"""Main text of web pages by wrappers inferred for each host: union-free regular expressions over page structure.

A wrapper is a sequence of items: a text slot, an element with a sequence of its own, or a group of items; each may be optional or
repeated. A page's tree is one already. Two sequences are aligned by their labels: equal labels are matched and their insides aligned
in turn, texts that differ become an open slot, what only one side has becomes optional, and neighbours that repeat, alone or as a
group, fold into a repetition. Where a sequence mixes more than `WIDEST` items it becomes a repetition of optional ones, so a wrapper is
bounded by the labels there are, however many pages it covers.

Each slot counts the texts, letters and linked letters of all its pages. That decides which slots are main text, once for all pages
of the host; a page is then aligned with its wrapper and gives the texts of these slots.
"""

from __future__ import annotations

import json
from collections import OrderedDict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartstream.llm.html_tree import Element, Text, read
from cartstream.llm.url_filters import url_host
from cartstream.session import cut_lineage, scratch

WIDEST = 40  # items of a sequence
LONGEST_GROUP = 4  # items of a repeated group
HOSTS = 2000  # wrappers a task holds at once
FAN_IN = 32  # partial wrappers merged by one task
SAME_ON = 3  # pages on which a text must be the same to count as part of the template

LOOSE = "(*"
BAD = frozenset(["ad", "nav", "side", "note", "talk", "head", "foot", "share", "form"])


class Item:
    """One item of a wrapper. `const` is the digest of a slot's text while all its pages agree; `texts` are a page's own."""

    __slots__ = ("label", "kids", "many", "opt", "const", "chars", "links", "pages", "main", "texts")

    def __init__(self, label, kids=(), many=False, opt=False, const=None, chars=0, links=0, pages=1, main=None, texts=()):
        self.label, self.kids, self.many, self.opt, self.const = label, kids, many, opt, const
        self.chars, self.links, self.pages, self.main, self.texts = chars, links, pages, main, texts

    def pack(self) -> list:
        return [self.label, [k.pack() for k in self.kids], int(self.many), int(self.opt), self.const, self.chars, self.links, self.pages, self.main]

    @classmethod
    def unpack(cls, packed: list) -> Item:
        label, kids, many, opt, *rest = packed
        return cls(label, [cls.unpack(k) for k in kids], bool(many), bool(opt), *rest)


def merge(a: Item, b: Item, across: bool) -> Item:
    """One item for both; `across` when they come from different pages."""
    return Item(
        a.label, a.kids if not b.kids else b.kids if not a.kids else align(a.kids, b.kids, across), a.many or b.many, a.opt or b.opt,
        a.const if a.const == b.const else None, a.chars + b.chars, a.links + b.links, a.pages + b.pages if across else max(a.pages, b.pages),
        a.main if a.main is not None else b.main, [*a.texts, *b.texts] if a.texts and b.texts else a.texts or b.texts,
    )


def loosened(items: list[Item]) -> list[Item]:
    """A repetition of optional items, one of each label: it covers any order of them."""
    first: dict[str, Item] = {}
    for item in items:
        for own in item.kids if item.label.startswith("(") else [item]:
            have = first.get(own.label)
            first[own.label] = own if have is None else merge(have, own, False)
            first[own.label].opt = first[own.label].many = True
    return [Item(LOOSE, sorted(first.values(), key=lambda i: i.label), many=True, pages=max((i.pages for i in items), default=1))]


def group(parts: list[list[Item]], across: bool = False) -> Item:
    kids = parts[0]
    for other in parts[1:]:
        kids = [merge(a, b, across) for a, b in zip(kids, other, strict=True)]
    return Item("(" + " ".join(k.label for k in kids) + ")", kids, many=len(parts) > 1, pages=max(k.pages for k in kids))


def folded(items: list[Item]) -> list[Item]:
    """Neighbours that repeat become one item or group that may be repeated."""
    out: list[Item] = []
    for item in items:
        if out and out[-1].label == item.label:
            out[-1] = merge(out[-1], item, False)
            out[-1].many = True
        else:
            out.append(item)
    if len(out) > 1 and any(i.label == LOOSE for i in out):
        return loosened(out)
    for size in range(2, LONGEST_GROUP + 1):
        k, kept, labels = 0, [], [i.label for i in out]
        while k < len(out):
            end = k + size
            while labels[k : k + size] == labels[end : end + size] and end + size <= len(out):
                end += size
            # Groups are not nested in groups; their labels stay of bounded length.
            if end > k + size and not any(x.startswith("(") for x in labels[k : k + size]):
                kept.append(group([out[j : j + size] for j in range(k, end, size)]))
                k = end
            else:
                kept.append(out[k])
                k += 1
        out = kept
    return loosened(out) if len(out) > WIDEST else out


def grouped_like(items: list[Item], other: list[Item]) -> list[Item]:
    """Runs of items that the other side has as a group, as that group."""
    for key in {i.label: len(i.kids) for i in other if i.label.startswith("(") and i.label != LOOSE}.items():
        label, size = key
        names, k, out = label[1:-1].split(" "), 0, []
        while k < len(items):
            if [i.label for i in items[k : k + size]] == names:
                out.append(group([items[k : k + size]]))
                k += size
            else:
                out.append(items[k])
                k += 1
        items = out
    return items


def matches(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Index pairs of a longest common subsequence."""
    if a == b:
        return [(k, k) for k in range(len(a))]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        row, below = best[i], best[i + 1]
        for j in range(len(b) - 1, -1, -1):
            row[j] = below[j + 1] + 1 if a[i] == b[j] else max(below[j], row[j + 1])
    pairs, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return pairs


def align(a: list[Item], b: list[Item], across: bool = True) -> list[Item]:
    """The sequence that covers both."""
    if [i.label for i in a] == [i.label for i in b]:
        return [merge(x, y, across) for x, y in zip(a, b, strict=True)]
    if any(i.label == LOOSE for i in a) or any(i.label == LOOSE for i in b):
        one, two = (loosened(x)[0] if x else None for x in (a, b))
        if one is None or two is None:
            return [one or two]
        have = {i.label: i for i in one.kids}
        for item in two.kids:
            have[item.label] = merge(have[item.label], item, across) if item.label in have else item
        pages = one.pages + two.pages if across else max(one.pages, two.pages)
        return [Item(LOOSE, sorted(have.values(), key=lambda i: i.label), many=True, pages=pages)]
    a, b = grouped_like(a, b), grouped_like(b, a)
    out, i, j = [], 0, 0
    for x, y in [*matches([k.label for k in a], [k.label for k in b]), (len(a), len(b))]:
        for alone in (*a[i:x], *b[j:y]):
            alone = Item(*(getattr(alone, s) for s in Item.__slots__))
            alone.opt = True
            out.append(alone)
        if x < len(a):
            out.append(merge(a[x], b[y], across))
        i, j = x + 1, y + 1
    return folded(out)


def items_of(node: Element, numbers: dict[int, int] | None = None) -> list[Item]:
    """A page's tree as a wrapper of this one page; with `numbers` (by identity) the texts keep their number."""
    out = []
    for kid in node.kids:
        if isinstance(kid, Text):
            texts = () if numbers is None else [numbers[id(kid)]]
            const = None if numbers is not None else kid.digest()
            out.append(Item("#", const=const, chars=len(kid.text), links=kid.links, texts=texts))
        else:
            out.append(Item(kid.label, items_of(kid, numbers)))
    return folded(out)


# -- which slots are main text -------------------------------------------------

def part_of(label: str) -> str:
    return label.partition(".")[2]


def kind_of(node: Element) -> str:
    """What marks the main text on a page: an article, a main part, an article body, or nothing. Pages of a kind share a wrapper."""
    found, stack = set(), [node]
    while stack:
        element = stack.pop()
        for kid in element.kids:
            if isinstance(kid, Element) and part_of(kid.label) not in ("nav", "side", "foot", "talk"):
                found.add("article" if kid.label == "article" else part_of(kid.label))
                stack.append(kid)
    return next((k for k in ("article", "main", "body") if k in found), "plain")


def _is(item: Item, kind: str) -> bool:
    return item.label == "article" if kind == "article" else part_of(item.label) == kind


def _holds(item: Item, kind: str) -> bool:
    return any(_is(k, kind) or _holds(k, kind) for k in item.kids)


def _weigh(item: Item) -> int:
    return item.chars + sum(map(_weigh, item.kids))


def _excluded(item: Item, kind: str, total: int, inside: bool) -> bool:
    """Is this part of the page left out? Not if it holds what marks the main text or, without a mark, most of the text."""
    tag, _, part = item.label.partition(".")
    if part not in BAD or (inside and part == "head"):
        return False
    if tag in ("nav", "footer", "aside") or part == "talk":
        return True
    if not inside and kind != "plain" and _holds(item, kind):
        return False
    return inside or kind != "plain" or 2 * _weigh(item) <= total


def mark(items: list[Item], kind: str) -> None:
    """Sets `main` on every item of a wrapper."""
    total = sum(map(_weigh, items))

    def own(slot: Item) -> bool:
        return 2 * slot.links <= slot.chars and not (slot.const and slot.pages >= SAME_ON)

    def eligible(item: Item, strict: bool) -> int:
        if item.label == "#":
            return item.chars if not strict or own(item) else 0
        return 0 if _excluded(item, kind, total, False) else sum(eligible(k, strict) for k in item.kids)

    def spread(item: Item, inside: bool, strict: bool) -> None:
        if item.label == "#":
            item.main = inside and (not strict or own(item))
            return
        inside = inside and not _excluded(item, kind, total, True)
        item.main = inside
        for kid in item.kids:
            spread(kid, inside, strict)

    def search(item: Item) -> None:
        for kid in item.kids:
            if _excluded(kid, kind, total, False):
                spread(kid, False, False)
            elif _is(kid, kind):
                spread(kid, True, False)
            else:
                kid.main = False
                search(kid)

    root = Item("page", items)
    if kind != "plain":
        search(root)
        return
    # Down to the element that holds nearly all of the text that is neither links nor the same everywhere.
    strict = sum(eligible(k, True) for k in items) > 0
    at = root
    spread(root, False, False)
    while True:
        all_here = sum(eligible(k, strict) for k in at.kids)
        inner = max(at.kids, key=lambda k: eligible(k, strict), default=None)
        if inner is None or inner.label == "#" or all_here == 0 or 10 * eligible(inner, strict) < 8 * all_here:
            break
        at = inner
    at.main = True  # also what a page has here beside the wrapper's items
    for kid in at.kids:
        spread(kid, True, strict)


def main_texts(node: Element, wrapper: list[Item]) -> list[str]:
    """The page's texts in main slots, in page order."""
    texts: list[str] = []
    numbers: dict[int, int] = {}
    stack: list = [iter([node])]
    while stack:
        kid = next(stack[-1], None)
        if kid is None:
            stack.pop()
        elif isinstance(kid, Text):
            numbers[id(kid)] = len(texts)
            texts.append(kid.text)
        else:
            stack.append(iter(kid.kids))
    chosen: list[int] = []

    def walk(items: list[Item], main: bool) -> None:
        for item in items:
            # An item the alignment could not match goes by the part it plays.
            here = item.main if item.main is not None else main and (part_of(item.label) not in BAD or part_of(item.label) == "head")
            if here and item.label == "#":
                chosen.extend(item.texts)
            walk(item.kids, here)

    walk(align(wrapper, items_of(node, numbers)), False)
    return [texts[k] for k in sorted(chosen)]


# -- over tables ---------------------------------------------------------------

Wrappers = dict[str, list[Item]]


def packed(wrappers: Wrappers) -> str:
    return json.dumps({k: [i.pack() for i in wrappers[k]] for k in sorted(wrappers)}, separators=(",", ":"))


def unpacked(text: str) -> Wrappers:
    return {k: [Item.unpack(i) for i in items] for k, items in json.loads(text).items()}


def joined(a: Wrappers, b: Wrappers) -> Wrappers:
    return {k: align(a[k], b[k]) if k in a and k in b else a.get(k) or b.get(k, []) for k in {*a, *b}}


def infer(pages: DataFrame) -> DataFrame:
    """host, wrapper: of every page, first inside each task, then `FAN_IN` partial wrappers at a time.

    `pages` has host and html. A host's partial wrappers differ in place only by the input partition, so no group grows with the data.
    """
    fields = "host string, part int, nth long, wrapper string"

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: OrderedDict[str, Wrappers] = OrderedDict()
        part, nth = 0, 0

        def out(hosts: list[tuple[str, Wrappers]]) -> pa.RecordBatch:
            nonlocal nth
            n = len(hosts)
            nth += n
            return pa.RecordBatch.from_arrays(
                [pa.array([h for h, _ in hosts], pa.string()), pa.array([part] * n, pa.int32()),
                 pa.array(range(nth - n, nth), pa.int64()), pa.array([packed(w) for _, w in hosts], pa.string())],
                names=["host", "part", "nth", "wrapper"],
            )

        for batch in batches:
            hosts = batch.column(0).to_pylist()
            part = batch.column(2)[0].as_py() if len(hosts) else part
            for host, source in zip(hosts, batch.column(1).to_pylist(), strict=True):
                node = read(source)
                page = {kind_of(node): items_of(node)}
                have = held.pop(host, None)
                held[host] = page if have is None else joined(have, page)
                if len(held) > HOSTS:
                    yield out([held.popitem(last=False)])
        yield out(list(held.items()))

    def together(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("part", "nth", "wrapper")), strict=True))
        total: Wrappers = {}
        for _, _, text in rows:
            total = joined(total, unpacked(text))
        return pa.table({
            "host": pa.array([table.column("host")[0].as_py()], pa.string()), "part": pa.array([rows[0][0] // FAN_IN], pa.int32()),
            "nth": pa.array([0], pa.int64()), "wrapper": pa.array([packed(total)], pa.string()),
        })

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                wrappers = unpacked(text)
                for kind, items in wrappers.items():
                    mark(items, kind)
                out.append(packed(wrappers))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["host", "wrapper"])

    with scratch(pages.select("host", "html", F.spark_partition_id().alias("part")).mapInArrow(partial, fields), "zstd") as first:
        rounds, last = first.df, first.df.agg(F.max("part")).first()[0] or 0
        while True:
            rounds = rounds.groupBy("host", F.floor(F.col("part") / FAN_IN).alias("_to")).applyInArrow(together, fields)
            last //= FAN_IN
            if not last:
                break
        return cut_lineage(rounds.select("host", "wrapper").mapInArrow(finish, "host string, wrapper string"), "zstd")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text (main text, blocks joined by a line break), n_chars of every page.

    White space inside a block (of any Unicode kind, line breaks by <br> too) is one space. A page without a url, or
    without '://', belongs to the empty host. A null or empty html gives an empty text; repeated rows each give a row; null ids and urls
    stay null; other columns are ignored; an empty table gives no rows. A host that holds most pages is one wrapper row, which Spark
    broadcasts while the wrappers' table is small and joins with skew splitting otherwise.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), F.coalesce(url_host(F.col("url")), F.lit("")).alias("host"),
    )
    wrappers = infer(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: OrderedDict[str, Wrappers] = OrderedDict()
        for batch in batches:
            texts = []
            for source, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                wrapper = known.get(text)
                if wrapper is None:
                    wrapper = known[text] = unpacked(text)
                    if len(known) > HOSTS:
                        known.popitem(last=False)
                node = read(source)
                texts.append("\n".join(main_texts(node, wrapper.get(kind_of(node), []))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return rows.join(wrappers, "host").select("page_id", "url", "html", "wrapper").mapInArrow(
        run, "page_id long, url string, text string, n_chars long"
    )
