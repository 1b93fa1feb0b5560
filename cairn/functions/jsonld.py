"""Entities of JSON-LD documents: a flat @graph whose entities point to each other by @id.

Documents are read as variants, so an absent field, a null and a value of another type are told apart. Look-ups
by @id search the graph's sorted ids, so a document takes time in proportion to its size, but for a logarithm."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

#: Fixed value: what a site entity's @id starts with; documentation entities likewise.
SITE_PREFIX = "http://kulturarvsdata.se/raa/lamning/"
DOC_PREFIX = "http://kulturarvsdata.se/raa/dokumentation/"
PLACES = (("Province", "ksam:provinceName"), ("County", "ksam:countyName"), ("Municipality", "ksam:municipalityName"), ("Parish", "ksam:parishName"))
LISTS = (("ksam:itemDescription", "ksam:desc"), ("ksam:itemSpecification", "ksam:spec"), ("ksam:itemNumber", "ksam:number"))
LABELLED = "array<struct<type:string,text:string>>"


def graph(body: Column) -> Column:
    """array<variant>: the entities; null without a list."""
    return _graph(F.try_parse_json(body))


def _graph(document: Column) -> Column:
    return F.try_variant_get(document, "$['@graph']", "array<variant>")


def field(entity: Column, name: str) -> Column:
    """variant: a field of an object. Absent ones are null, a JSON null is a variant."""
    return F.try_variant_get(entity, f"$['{name}']", "variant")


def plain(entity: Column, name: str) -> Column:
    """A field's text; null where it is absent or null."""
    return F.try_variant_get(entity, f"$['{name}']", "string")


def value(entity: Column, name: str) -> Column:
    """The @value of the object in a field, as text."""
    return F.try_variant_get(entity, f"$['{name}']['@value']", "string")


def is_object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>").isNotNull()


def is_list(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>").isNotNull()


def misplaced(v: Column) -> Column:
    """True where something else, null too, stands in an object's place; absent fields don't."""
    return v.isNotNull() & ~is_object(v)


def _id(entity: Column) -> Column:
    """The @id if it is a string."""
    at = field(entity, "@id")
    return F.when(F.schema_of_variant(at) == "STRING", F.try_variant_get(at, "$", "string"))


def main_entity(g: Column, prefix: str = SITE_PREFIX) -> Column:
    """The first entity whose @id starts with the prefix."""
    return F.get(F.filter(g, lambda e: F.startswith(_id(e), F.lit(prefix))), F.lit(0))


def index(g: Column) -> Column:
    """struct(ids, entities): the entities as they are, and array<struct<id, at>> sorted, for look-ups; null without a graph."""
    ids = lambda x: F.sort_array(F.filter(F.transform(x, lambda e, k: F.struct(_id(e).alias("id"), k.alias("at"))), lambda x: x["id"].isNotNull()))
    return let(g, lambda x: F.when(x.isNotNull(), F.struct(ids(x).alias("ids"), x.alias("entities"))))


def pointed(known: Column, at: Column) -> Column:
    """The last entity with an @id, null where it points to nothing; known: the graph's index.

    Halving steps find how many ids are not beyond the one looked for."""

    def halve(s: Column, _: Column) -> Column:
        mid = F.shiftright(s["lo"] + s["hi"], 1)
        upper = (s["lo"] < s["hi"]) & (F.get(known["ids"], mid)["id"] <= at)
        return F.struct(F.when(upper, mid + 1).otherwise(s["lo"]).alias("lo"), F.when(upper, s["hi"]).otherwise(mid).alias("hi"))

    n = F.size(known["ids"])
    start = F.struct(F.lit(0).alias("lo"), n.alias("hi"))
    upto = F.aggregate(F.sequence(F.lit(1), F.length(F.bin(n))), start, halve)["lo"]
    return let(F.get(known["ids"], upto - 1), lambda x: F.when(x["id"] == at, F.get(known["entities"], x["at"])))


def entity(g: Column, at: Column) -> Column:
    """pointed for a single look-up in a graph."""
    return let(index(g), lambda known: pointed(known, at))


def refs(main: Column, name: str) -> Column:
    """@ids of a list of references; a single object or anything else is no list."""
    return F.filter(F.transform(F.try_variant_get(main, f"$['{name}']", "array<variant>"), _id), lambda x: x.isNotNull())


def _contents(known: Column, ids: Column, content: str) -> Column:
    """array<struct<type, text>> of the entities with these @ids; empty contents left out."""

    def read(at: Column) -> Column:
        kind = lambda e: F.when(F.try_variant_get(e, "$['ksam:type']['@value']", "variant").isNull(), "Unknown").otherwise(F.coalesce(value(e, "ksam:type"), F.lit("None")))
        return let(pointed(known, at), lambda e: F.struct(kind(e).alias("type"), F.coalesce(value(e, content), F.lit("")).alias("text")))

    got = F.coalesce(F.transform(ids, read), F.array().cast(LABELLED))
    return F.filter(got, lambda x: x["text"] != "")


def labelled(g: Column, main: Column, name: str, content: str) -> Column:
    """array<struct<type, text>> of the entities that a list names; empty contents left out."""
    return let(index(g), lambda known: _contents(known, refs(main, name), content))


def _filled(label: Column, text: Column) -> Column:
    return F.concat(label, F.lit(": "), text)


def _context(known: Column, main: Column) -> Column:
    return let(_id(field(main, "ksam:context")), lambda at: F.when(at.isNotNull(), pointed(known, at)))


def _places(context: Column) -> Column:
    """Labelled place names of the context entity; empty without one."""
    given = F.filter(F.array(*[F.struct(F.lit(n).alias("label"), value(context, f).alias("text")) for n, f in PLACES]), lambda x: x["text"] != "")
    return F.when(context.isNotNull(), F.transform(given, lambda x: _filled(x["label"], x["text"]))).otherwise(F.array().cast("array<string>"))


def places(g: Column, main: Column) -> Column:
    """Labelled place names from the context entity; empty without one."""
    return let(index(g), lambda known: let(_context(known, main), _places))


def _lists(main: Column) -> Column:
    """struct of the @ids that each of LISTS names."""
    return F.struct(*[refs(main, name).alias(f"l{i}") for i, (name, _) in enumerate(LISTS)])


def _parts(known: Column, main: Column, lists: Column, context: Column) -> Column:
    def ones(*rows: tuple[str, Column, str | None]) -> Column:
        all_ = F.array(*[F.struct(F.lit(name).cast("string").alias("field"), F.lit(label).alias("label"), c.alias("text")) for label, c, name in rows])
        return F.transform(F.filter(all_, lambda x: x["text"] != ""), lambda x: F.struct(x["field"].alias("field"), _filled(x["label"], x["text"]).alias("text")))

    def many(i: int) -> Column:
        return F.transform(_contents(known, lists[f"l{i}"], LISTS[i][1]), lambda x: F.struct(x["type"].alias("field"), _filled(x["type"], x["text"]).alias("text")))

    line = F.array(F.struct(F.lit("geographic").alias("field"), F.array_join(_places(context), " | ").alias("text")))
    return F.concat(
        ones(("Title", plain(main, "ksam:itemTitle"), None), ("Class", value(main, "ksam:itemClassName"), None)), many(0), F.filter(line, lambda x: x["text"] != ""), many(1), many(2),
        ones(("Organization", value(main, "ksam:serviceOrganization"), "organization"), ("Build Date", plain(main, "ksam:buildDate"), "buildDate"), ("Last Changed", plain(main, "ksam:lastChangedDate"), "lastChanged"), ("URL", plain(main, "ksam:url"), "url")),
    )


def parts(g: Column, main: Column) -> Column:
    """array<struct<field, text>> of a description, in its fixed order; field is null for title and class."""
    return let(index(g), lambda known: let(_lists(main), lambda lists: let(_context(known, main), lambda context: _parts(known, main, lists, context))))


def _main_at(known: Column, prefix: str) -> Column:
    """The main entity's place in the graph, from 0; null without one."""
    return F.array_min(F.transform(F.filter(known["ids"], lambda x: F.startswith(x["id"], F.lit(prefix))), lambda x: x["at"]))


def _read(document: Column, prefix: str, use) -> Column:
    """use(index, main entity's place, main entity, lists, context) of a document."""

    def placed(known: Column, nth: Column) -> Column:
        return let(F.get(known["entities"], nth), lambda main: let(_lists(main), lambda lists: let(_context(known, main), lambda context: use(known, nth, main, lists, context))))

    return let(index(_graph(document)), lambda known: let(_main_at(known, prefix), lambda nth: placed(known, nth)))


def _description(known: Column, nth: Column, main: Column, lists: Column, context: Column) -> Column:
    text = F.array_join(F.transform(_parts(known, main, lists, context), lambda x: x["text"]), "\n\n")
    found = let(text, lambda t: F.when(t == "", "No description available").otherwise(t))
    return F.when(known.isNull(), "No data available").when(main.isNull(), "Main entity not found").otherwise(found)


def description(body: Column, prefix: str = SITE_PREFIX) -> Column:
    return _read(F.try_parse_json(body), prefix, _description)


def keywords(main: Column) -> Column:
    """JSON text of a list, fields of objects in order of name: a list as it is, one value wrapped, empty or absent ones null."""
    raw = field(main, "ksam:itemKeyword")

    def told(text: Column) -> Column:
        empty = text.isNull() | text.isin("", "[]", "{}")
        list_ = F.when(is_list(raw), text).when(is_object(raw), F.concat(F.lit("["), text, F.lit("]"))).otherwise(F.to_json(F.array(text)))
        return F.when(~empty, list_)

    return let(F.try_variant_get(raw, "$", "string"), told)


def keyword_list(json_text: Column) -> Column:
    """Plain strings of a keyword list whose members may be {"@value": k} objects."""
    return F.transform(F.from_json(json_text, "array<string>"), lambda x: F.when(F.startswith(x, F.lit("{")), F.get_json_object(x, "$['@value']")).otherwise(x))


def _astray(content: str):
    return lambda e: F.coalesce(misplaced(field(e, "ksam:type")) | misplaced(field(e, content)), F.lit(False))


def enrichment(body: Column, prefix: str = SITE_PREFIX) -> Column:
    """struct(itemKeyword, itemTitle, description, error) of one response.

    All null without a main entity. A null or another value in an object's place, whether in the main entity, in
    one that its lists name, or in its context, makes the whole record null and sets error; so do a null or a
    number in the graph's place or in an entity's, and an @id before the main entity that is no string."""

    def of(document: Column) -> Column:
        top = field(document, "@graph")

        def record(known: Column, nth: Column, main: Column, lists: Column, context: Column) -> Column:
            def wrong() -> Column:
                out = misplaced(field(main, "ksam:itemClassName")) | misplaced(field(main, "ksam:serviceOrganization"))
                for i, (_, content) in enumerate(LISTS):
                    targets = F.transform(F.coalesce(lists[f"l{i}"], F.array().cast("array<string>")), lambda x: pointed(known, x))
                    out = out | F.exists(targets, _astray(content))
                places = context.isNotNull() & F.exists(F.array(*[misplaced(field(context, f)) for _, f in PLACES]), lambda x: x)
                return out | F.coalesce(places, F.lit(False))

            bare = lambda e: ~is_object(e) & ~is_list(e) & (F.schema_of_variant(e) != "STRING")
            lost = known.isNull() & top.isNotNull() & ~(is_object(top) | (F.schema_of_variant(top) == "STRING"))
            ahead = F.slice(known["entities"], F.lit(1), F.coalesce(nth, F.size(known["entities"])))
            nameless = F.exists(ahead, lambda e: is_object(e) & field(e, "@id").isNotNull() & _id(e).isNull())
            unread = F.exists(known["entities"], bare) & main.isNotNull()
            odd = (F.size(known["ids"]) < F.size(known["entities"])) & (F.coalesce(nameless, F.lit(False)) | F.coalesce(unread, F.lit(False)))  # entities with an id as text are objects
            bad = lost | F.coalesce(odd, F.lit(False)) | (main.isNotNull() & F.coalesce(wrong(), F.lit(False)))

            def fields(bad_: Column) -> Column:
                ok = main.isNotNull() & ~bad_
                return F.struct(F.when(ok, keywords(main)).alias("itemKeyword"), F.when(ok, plain(main, "ksam:itemTitle")).alias("itemTitle"), F.when(ok, _description(known, nth, main, lists, context)).alias("description"), bad_.alias("error"))

            return let(F.coalesce(bad, F.lit(False)), fields)

        return _read(document, prefix, record)

    return let(F.try_parse_json(body), of)
