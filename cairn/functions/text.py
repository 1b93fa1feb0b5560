"""Descriptions: the block parser, the line parser, and clean-up, as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Block names that become columns, with the columns' names.
BLOCK_COLUMNS = {
    "Class": "class", "Skadestatus": "damage_status", "Placering": "location", "Undersökningsstatus": "investigation_status",
    "Province": "province", "Aktualitetsstatus": "current_status", "Antikvarisk bedömning": "heritage_assessment", "Organization": "organization",
    "Build Date": "build_date", "Last Changed": "last_changed", "URL": "url", "Beskrivning": "description_swedish",
    "RAÄ-nummer": "raa_number", "Lämningsnummer": "site_number", "Terräng": "terrain", "Referens": "reference",
    "Orientering": "orientation", "Title": "title", "Vegetation": "vegetation", "Tradition": "tradition",
}
#: Line labels and the field that each starts.
LINE_FIELDS = {
    "Class": "class", "Klass": "class", "Skadestatus": "damage_status", "Undersökningsstatus": "exam_status",
    "Beskrivning": "description_sv", "Placering": "placement", "Terräng": "terrain", "Orientering": "orientation",
    "Province": "province_line", "County": "province_line", "Municipality": "province_line", "Parish": "province_line",
    "Aktualitetsstatus": "actuality_status", "Antikvarisk bedömning": "antiquarian_assessment", "Lämningsnummer": "lamningsnummer", "RAÄ-nummer": "raa_number",
    "Organization": "organization", "Build Date": "build_date", "Last Changed": "last_changed", "URL": "url",
    "Title": "title", "Tradition": "tradition", "Referens": "reference", "References": "reference",
}
#: Fields that lose web addresses, and the disclaimers.
URL_FREE = ("description_sv", "terrain", "orientation", "placement", "reference", "tradition", "title")
DISCLAIMERS = r"(?iuU)Beskrivningen är inte kvalitetssäkrad\.?|Information kan saknas, vara felaktig eller inaktuell\.?|Se även\s+Inventeringsbok\.?"

#: White space of any kind, and the byte order mark.
SPACES = "".join(map(chr, [*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF]))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.btrim(c, F.lit(SPACES))


def strip_urls(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"(?iU)https?://\S+", ""))


def strip_disclaimers(c: Column) -> Column:
    return strip(F.regexp_replace(c, DISCLAIMERS, ""))


def normalise(c: Column) -> Column:
    """Column name of a label: å, ä, ö (lower case only) without marks, blanks to underscores, lower case."""
    return F.lower(F.translate(c, "åäö ", "aao_"))


def blocks(description: Column) -> Column:
    """key, value and the whole entry of each block between empty lines."""

    def cut(e: Column) -> Column:
        at = F.instr(e, ":")
        key = F.when(at > 0, F.substring(e, F.lit(1), at - 1)).otherwise(F.substring(e, F.lit(1), F.length(e) - 1))
        value = F.when(at > 0, F.substring(e, at + 1, F.length(e))).otherwise(e)
        return F.struct(strip(key).alias("key"), strip(value).alias("value"), e.alias("entry"))

    return F.transform(F.split(description, "\n\n", -1), cut)


def block_names(strict: bool = False) -> dict[str, str]:
    """Label -> column of the known blocks; strict: only those whose normalised label is their name, as the register's own guard lets through."""
    low = str.maketrans("åäö ", "aao_")
    return {k: c for k, c in BLOCK_COLUMNS.items() if not strict or k.translate(low).lower() == c}


def block_columns(description: Column, strict: bool = False) -> Column:
    """struct of the known blocks, the last of equal names, rest with the others, and rejected.

    A null or empty description gives nulls. strict: see block_names; rejected lists the labels that occur
    and that the guard keeps out, with their normalised names. The text is parsed once for all fields."""
    allowed = block_names(strict)
    known = F.array(*[F.lit(k) for k in BLOCK_COLUMNS])
    refused = F.array(*[F.lit(k) for k in BLOCK_COLUMNS if k not in allowed]).cast("array<string>")

    def rest(others: Column) -> Column:
        first = F.array_position(F.transform(others, lambda e: e == ""), F.lit(False)).cast("int")  # empty ones before it go
        return F.when(first > 0, F.array_join(F.slice(others, F.greatest(first, F.lit(1)), F.size(others)), "\n\n")).otherwise(F.lit(""))

    def fields(parts: Column, keys: Column) -> Column:
        last = lambda label: F.get(parts, F.array_position(keys, F.lit(label)).cast("int") - 1)["value"]
        others = F.transform(F.filter(F.reverse(parts), lambda b: ~F.array_contains(known, b["key"])), lambda b: b["entry"])
        out = F.transform(F.filter(refused, lambda k: F.array_contains(keys, k)), lambda k: F.struct(k.alias("label"), normalise(k).alias("name")))
        return F.struct(*[last(k).alias(c) for k, c in allowed.items()], let(others, rest).alias("rest"), out.alias("rejected"))

    got = let(F.reverse(blocks(description)), lambda parts: let(F.transform(parts, lambda b: b["key"]), lambda keys: fields(parts, keys)))
    return F.when(description.isNotNull() & (description != ""), got)


def sections(text: Column) -> Column:
    """Field and stripped value of each section of labelled lines, in order; empty ones left out."""
    names = F.create_map(*[F.lit(x) for kv in LINE_FIELDS.items() for x in kv])

    def read(line: Column) -> Column:
        at = F.instr(line, ":")
        key = F.when(at > 0, names[strip(F.substring(line, F.lit(1), at - 1))])
        return F.struct(key.alias("key"), F.when(key.isNotNull(), strip(F.substring(line, at + 1, F.length(line)))).otherwise(line).alias("value"))

    def gather(lines: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.get(lines, i)["key"].isNotNull())

        def section(at: Column, i: Column, j: Column) -> Column:
            own = F.slice(lines, i + 1, F.coalesce(F.get(at, j + 1), F.size(lines)) - i)
            return F.struct(F.get(lines, i)["key"].alias("key"), strip(F.array_join(F.transform(own, lambda x: x["value"]), "\n")).alias("value"))

        return let(starts, lambda at: F.transform(at, lambda i, j: section(at, i, j)))

    lines = F.transform(F.split(text, r"\R|[\x1c-\x1e]", -1), lambda s: let(strip(s), read))
    return F.when(text.isNotNull(), F.filter(let(lines, gather), lambda s: s["value"] != ""))


def line_fields(found: Column, names: list[str] | None = None, fix_first: bool = False) -> dict[str, Column]:
    """Columns of `sections`: values of one field joined by line ends, null where absent.

    province, county, municipality and parish come from the line that has them, split at |; its first
    label has been cut off, so that part is lost unless fix_first names it province."""
    wanted = names or list(dict.fromkeys(LINE_FIELDS.values()))

    def joined(field: str) -> Column:
        own = F.transform(F.filter(found, lambda s: s["key"] == field), lambda s: s["value"])
        text = let(own, lambda v: F.when(F.size(v) > 0, F.array_join(v, "\n")))
        return strip_urls(text) if field in URL_FREE else text

    out = {n: joined(n) for n in wanted if n not in ("province", "county", "municipality", "parish")}
    line = joined("province_line")
    line = F.when(line.isNotNull(), F.concat(F.lit("Province: "), line)) if fix_first else line
    parts = F.filter(F.transform(F.split(line, r"\|", -1), strip), lambda p: F.contains(p, F.lit(":")))
    for n in ("province", "county", "municipality", "parish"):
        if names is None or n in names:
            own = F.filter(parts, lambda p: F.lower(strip(F.substring_index(p, ":", 1))) == n)  # noqa: B023
            out[n] = let(F.try_element_at(own, F.lit(-1)), lambda hit: strip(F.substring(hit, F.instr(hit, ":") + 1, F.length(hit))))
    return out


def first_uuid(c: Column) -> Column:
    found = F.regexp_extract(c, r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", 0)
    return F.when(found != "", found)


def preview(c: Column, n: int) -> Column:
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def duration_label(ms: Column) -> Column:
    """ms, s or m with the plain quotient; hours and minutes from an hour on."""
    plain = lambda q: F.regexp_replace(q.cast("string"), r"\.0$", "")
    hours = F.floor(ms / 3_600_000).cast("string")
    minutes = F.floor((ms % 3_600_000) / 60_000).cast("string")
    return F.when(ms < 1000, F.concat(ms.cast("string"), F.lit("ms"))).when(ms < 60_000, F.concat(plain(ms / 1000), F.lit("s"))).when(ms < 3_600_000, F.concat(plain(ms / 60_000), F.lit("m"))).otherwise(F.concat(hours, F.lit("h "), minutes, F.lit("m")))
