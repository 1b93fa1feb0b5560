"""Secret scans in SQL functions only: three base patterns, and sliding-window Shannon entropy.

Candidates are long strings of one character class. Over each, a window of WINDOW characters slides; the
counts of its characters, packed five bits each, and with them the sum of n log2 n, change by the character
that comes in and the one that goes. The characters of windows at or above the class's entropy are spans,
but an allow-list's strings have none and its words cool every window that touches them.

All steps take time in proportion to the text: patterns have no repeated groups, running sums and maxima
go by blocks of about the square root of their number, and no array grows by copying more than a block.
The functions put SQL expressions together as text, which is parsed once for a column.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The base kinds' patterns.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # as long as AKIA[A-Z0-9]+ of 20 and more characters
HEX = r"[0-9a-f]{24,}"  # the runs of [0-9a-f]+ of 24 and more characters
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
SLICE = 512  # windows of a candidate that are judged in one go
#: Class: candidate pattern, its characters, least entropy of a window in bits.
CLASSES = {
    "hex": (r"(?<![A-Za-z0-9+/_=-])[0-9A-Fa-f]{20,}+(?![A-Za-z0-9+/_=-])", "0123456789abcdefABCDEF", 3.0),
    "base64": (r"[A-Za-z0-9+/_=-]{20,}+", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.9),
}
#: Whole candidates that are no secrets: words, also joined by rules; numbers and rules; UUIDs.
ALLOWED = (r"^[A-Za-z+/_=-]++$", r"^[0-9+/_=-]++$", r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$")
#: Words, in either case, that mark what is around them as no secret.
ALLOWED_WORDS = ("abcdefgh", "01234567", "12345678", "example", "sample", "placeholder", "redacted")


_names = count()


def let(value: str, body: Callable[[str], str]) -> str:
    """body of a name for the value, which is computed once."""
    x = f"v{next(_names)}"
    return f"get(transform(array({value}), {x} -> {body(x)}), 0)"


def literal(text: str) -> str:
    """A string of printable ASCII as SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def running(values: str, step: Callable[[str, str], str]) -> str:
    """What an associative step with the neutral element 0 gives over the integers up to each one.

    Blocks of about the square root of their number are run through, then their totals, then both are put
    together."""

    def along(part: str, first: str) -> str:
        a, x = f"a{next(_names)}", f"x{next(_names)}"
        grown = let(step(f"{a}.at", x), lambda at: f"named_struct('at', {at}, 'out', concat({a}.out, array({at})))")
        return f"aggregate({part}, named_struct('at', {first}, 'out', cast(array() as array<int>)), ({a}, {x}) -> {grown}, {a} -> {a}.out)"

    def joined(parts: str) -> str:
        totals = f"transform({parts}, p -> aggregate(p, 0, (a, x) -> {step('a', 'x')}))"
        return let(along(totals, "0"), lambda ends: f"flatten(transform({parts}, (p, k) -> {along('p', f'if(k = 0, 0, get({ends}, k - 1))')}))")

    def blocks(v: str) -> str:
        size = f"greatest(32, cast(ceil(sqrt(size({v}))) as int))"
        return let(size, lambda s: f"transform(sequence(0, size({v}) - 1, {s}), k -> slice({v}, k + 1, {s}))")

    return let(values, lambda v: f"if(size({v}) > 32, {let(blocks(v), joined)}, {along(v, '0')})")


def _plus(a: str, b: str) -> str:
    return f"{a} + {b}"


def _most(a: str, b: str) -> str:
    return f"greatest({a}, {b})"


def spans_of(text: str, pattern: str, kind: int, group: int = 0, least: int = 0) -> str:
    """array of (start, kind, end, word): the pattern's leftmost matches whose group has `least` characters, in code points.

    The pieces between matches and the matches themselves give the places."""
    found = f"regexp_extract_all({text}, {literal(pattern)}, 0)"
    size = f"regexp_extract_all({text}, {literal(pattern)}, {group})"

    def places(m: str) -> str:
        steps = f"zip_with(slice(split({text}, {literal(pattern)}, -1), 1, size({m})), {m}, (p, x) -> length(p) + length(x))"
        rows = f"zip_with({running(steps, _plus)}, {m}, (e, m) -> named_struct('start', e - length(m), 'kind', {kind}, 'end', e, 'word', m))"
        return f"transform(filter(zip_with({rows}, {size}, (r, g) -> named_struct('row', r, 'own', g)), x -> length(x.own) >= {least}), x -> x.row)" if least else rows

    return f"if(rlike({text}, {literal(pattern)}), {let(found, places)}, cast(array() as array<struct<start:int,kind:int,end:int,word:string>>))"


def bare(spans: str) -> str:
    return f"transform({spans}, x -> named_struct('start', x.start, 'kind', x.kind, 'end', x.end))"


def merged(spans: str, kind: int = 0) -> str:
    """Maximal runs of overlapping or touching spans, by start."""

    def runs(s: str) -> str:
        def cut(ends: str) -> str:
            starts = f"filter({s}, (x, i) -> i = 0 or x.start > get({ends}, i - 1))"
            lasts = f"filter({ends}, (e, i) -> i = size({s}) - 1 or get({s}, i + 1).start > e)"
            return f"zip_with({starts}, {lasts}, (x, e) -> named_struct('start', x.start, 'kind', {kind}, 'end', e))"

        return let(running(f"transform({s}, x -> x.end)", _most), cut)

    return let(f"array_sort({spans})", runs)


def hot_spans(word: str, alphabet: str, least: float, at: str = "0", window: int = WINDOW) -> str:
    """array of (start, kind, end): runs of characters in windows at or above `least` bits, those of two slices apart.

    Characters outside the alphabet stand in no such window. at: what is added to the places."""
    if window > 31:
        raise ValueError("counts have five bits")
    gain = [0.0, *[(k + 1) * math.log2(k + 1) - (k * math.log2(k) if k else 0.0) for k in range(1, window + 1)]]  # of n log2 n, from k to k + 1
    most = window * (math.log2(window) - least) + 1e-9
    fixed = lambda xs, kind: f"array({', '.join(f'{x}{kind}' for x in xs)})"
    gains, sizes = fixed(gain, "D"), range(len(alphabet))
    codes = fixed([alphabet.find(chr(c)) for c in range(128)], "")
    group, shift, unit = fixed([c // 12 for c in sizes], ""), fixed([c % 12 * 5 for c in sizes], ""), fixed([1 << c % 12 * 5 for c in sizes], "L")
    zero = f"array_repeat(0L, {-(-len(alphabet) // 12)})"
    number = lambda packed, c: f"cast(shiftright(get({packed}, get({group}, {c})), get({shift}, {c})) & 31L as int)"
    change = lambda packed, c, sign: let(f"get({group}, {c})", lambda g: f"transform({packed}, (v, j) -> if(j = {g}, v {sign} get({unit}, {c}), v))")

    def judged(chars: str, k: str) -> str:
        """Spans of the windows that start in a slice from place k on."""
        done = f"if(a.end > 0, concat(a.out, array(named_struct('start', {at} + a.start, 'kind', 3, 'end', {at} + a.end))), a.out)"

        def gone(g: str) -> str:
            less = f"named_struct('n', if({g} >= 0, {change('a.n', g, '-')}, a.n), 's', if({g} >= 0, a.s - get({gains}, {number('a.n', g)} - 1), a.s))"
            return let(less, lambda x: let(f"get({chars}, i)", lambda c: let(came(x, c), noted)))

        def came(x: str, c: str) -> str:
            return f"named_struct('n', if({c} >= 0, {change(f'{x}.n', c, '+')}, {x}.n), 's', if({c} >= 0, {x}.s + get({gains}, {number(f'{x}.n', c)}), {x}.s), 'bad', if({c} >= 0, a.bad, i))"

        def noted(x: str) -> str:
            hot = f"i - {k} >= {window - 1} and i - {x}.bad >= {window} and {x}.s <= {most!r}D"
            both = f"named_struct('hot', {hot}, 'fresh', {hot} and i - {window - 1} > a.end)"  # fresh: not in touch with the span before
            return let(both, lambda h: f"named_struct('n', {x}.n, 's', {x}.s, 'bad', {x}.bad, 'start', if({h}.fresh, i - {window - 1}, a.start), 'end', if({h}.hot, i + 1, a.end), 'out', if({h}.fresh, {done}, a.out))")

        leaving = f"if(i - {k} >= {window}, get({chars}, i - {window}), -1)"
        start = f"named_struct('n', {zero}, 's', 0.0D, 'bad', {k} - 1, 'start', 0, 'end', -1, 'out', cast(array() as array<struct<start:int,kind:int,end:int>>))"
        return f"aggregate(sequence({k}, least({k} + {SLICE + window - 2}, size({chars}) - 1)), {start}, (a, i) -> {let(leaving, gone)}, a -> {done})"

    chars = f"transform(filter(split({word}, ''), x -> x <> ''), x -> get({codes}, ascii(x)))"
    found = let(chars, lambda c: f"flatten(transform(sequence(0, size({c}) - {window}, {SLICE}), k -> {judged(c, 'k')}))")
    return f"if(length({word}) >= {window}, {found}, cast(array() as array<struct<start:int,kind:int,end:int>>))"


def _cooled(word: str) -> str:
    """The word with each allowed word replaced by marks."""
    out = word
    for x in ALLOWED_WORDS:
        out = f"regexp_replace({out}, '(?i){x}', '{'!' * len(x)}')"
    return f"if(rlike({word}, '(?i){'|'.join(ALLOWED_WORDS)}'), {out}, {word})"


def candidates(text: str, pattern: str, least: float) -> str:
    """Spans with their texts of a class's long strings, but for those that the allow-list knows.

    Entropy of `least` bits takes at least 2 ** least different characters."""
    return f"filter({spans_of(text, pattern, 3)}, x -> not rlike(x.word, {literal('|'.join(ALLOWED))}) and size(array_distinct(split(x.word, ''))) >= {math.ceil(2**least - 1e-6)})"


def entropy_spans(found: str, alphabet: str, least: float, window: int = WINDOW) -> str:
    """Spans of kind entropy in candidates."""
    return f"flatten(transform({found}, w -> {let(_cooled('w.word'), lambda c: hot_spans(c, alphabet, least, 'w.start', window))}))"


def uncovered(base: str, more: str) -> str:
    """Those of more, of kind 3, that no span of base covers, by start."""

    def keep(s: str) -> str:
        reach = running(f"transform({s}, x -> if(x.kind < 3, x.end, 0))", _most)
        return let(reach, lambda ends: f"filter({s}, (x, i) -> x.kind = 3 and get({ends}, i) < x.end)")

    return f"if(size({more}) = 0 or size({base}) = 0, {more}, {let(f'array_sort(concat({base}, {more}))', keep)})"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, entropy: bool = True) -> DataFrame:
    """(doc_id, kept columns, base, spans): arrays of (start, kind, end), by start, then kind, an index of KINDS.

    base has the three patterns' spans; spans adds those of kind entropy that no base span covers. Null and
    empty texts have none. Rows stay as they are, repeated and null ids too; no shuffle, no Python on executors.
    Time and memory grow with a text, however long. An empty table gives none; other columns are read only if
    they are kept, as kept_0, kept_1, …, so their names clash with none."""
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("scanned"), *[F.col(f"`{c}`").alias(f"kept_{i}") for i, c in enumerate(keep or [])])
    base = ", ".join(bare(x) for x in (spans_of("scanned", ASSIGN, 0, 2, 6), spans_of("scanned", ACCESS, 1), spans_of("scanned", HEX, 2)))
    rows = rows.withColumn("base", F.expr(f"array_sort(concat({base}))"))
    if entropy:  # column after column: the analyzer resolves nested functions one level at a time
        words = "transform(base, x -> named_struct('start', x.start, 'kind', x.kind, 'end', x.end, 'word', ''))"
        rows = rows.withColumns({f"long_{name}": F.expr(candidates("scanned", pattern, least)) for name, (pattern, _, least) in CLASSES.items()})
        rows = rows.withColumns({f"open_{name}": F.expr(uncovered(words, f"long_{name}")) for name in CLASSES})  # nothing in the others can count
        rows = rows.withColumns({f"hot_{name}": F.expr(entropy_spans(f"open_{name}", alphabet, least)) for name, (_, alphabet, least) in CLASSES.items()})
        rows = rows.withColumn("hot", F.expr(merged(f"concat({', '.join(f'hot_{name}' for name in CLASSES)})", 3)))
        rows = rows.withColumn("spans", F.expr(f"array_sort(concat(base, {uncovered('base', 'hot')}))"))
    else:
        rows = rows.withColumn("spans", F.col("base"))
    return rows.select("doc_id", *[F.col(f"kept_{i}").alias(c) for i, c in enumerate(keep or [])], "base", "spans")


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(x) for x in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def report(found: DataFrame) -> DataFrame:
    """Counts and texts of scan's rows."""
    n = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("bigint")
    return found.select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"), F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def redact(text: str, spans: str, mark: str = "[REDACTED]", block: int = 4096) -> Column:
    """The text with each run of overlapping or touching spans replaced by the mark; text and spans are SQL expressions.

    The text is cut into blocks of characters, so a piece costs its own blocks and not the text before it."""

    def kept(runs: str) -> str:
        before, until = f"concat(array(0), transform({runs}, x -> x.end))", f"concat(transform({runs}, x -> x.start), array(length({text})))"
        from_ = f"greatest(a - k * {block}, 0)"

        def pieces(parts: str) -> str:
            own = f"transform(sequence(a div {block}, (b - 1) div {block}), k -> substring(get({parts}, cast(k as int)), cast({from_} as int) + 1, cast(least(b - k * {block}, {block}) - {from_} as int)))"
            return f"array_join(zip_with({before}, {until}, (a, b) -> if(b > a, array_join({own}, ''), '')), {literal(mark)})"

        return let(f"regexp_extract_all({text}, '(?s).{{1,{block}}}', 0)", pieces)

    return F.expr(f"if(size({spans}) > 0, {let(merged(spans), kept)}, {text})")
