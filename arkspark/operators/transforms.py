"""Content transformation: stages over distinct contents, with links from each source to what became of it.

Contents are rows (sha, param_key, params, content): a content and the map of query parameters it stands for.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Stage = Callable[[DataFrame], DataFrame]


def param_key(params: Column) -> Column:
    """``k=v`` pairs of a map in order of key; null values count as empty."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(params)), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("")))), "&")


def regex_stage(pattern: str, template: str, case: str | None = None) -> Stage:
    """Replaces each match by a template of ``$n``; ``case`` (lower, upper) changes the groups first.

    With ``case`` each match is read again by itself, so its pattern must not look beyond the match.
    """

    def new_text(match: Column) -> Column:
        turn = {"lower": F.lower, "upper": F.upper}[case]
        parts, at = [], 0
        while at < len(template):
            end = at + 1
            if template[at] == "$" and template[end : end + 1].isdigit():
                end += 1
                parts.append(turn(F.regexp_extract(match, pattern, int(template[at + 1 : end]))))
            else:
                while end < len(template) and template[end] != "$":
                    end += 1
                parts.append(F.lit(template[at:end]))
            at = end
        return F.concat(*parts) if parts else F.lit("")

    def run(contents: DataFrame) -> DataFrame:
        if case is None:
            return contents.withColumn("content", F.regexp_replace("content", pattern, template))
        between = F.split("content", pattern, -1)
        matches = F.regexp_extract_all("content", F.lit(pattern), F.lit(0))
        return contents.withColumn("content", F.array_join(F.zip_with(between, matches, lambda text, match: F.concat(text, F.coalesce(new_text(match), F.lit("")))), ""))

    return run


def param_stage(name: str, pattern: str, values: Sequence[str | None]) -> Stage:
    """One content per value of a parameter, written in place of the pattern's first group; a null value leaves the text.

    Contents in which the pattern isn't found pass once, without the parameter.
    """

    def run(contents: DataFrame) -> DataFrame:
        found = F.col("content").rlike(pattern)
        many = contents.withColumn("_v", F.explode(F.when(found, F.array(*(F.struct(F.lit(v).cast("string").alias("v")) for v in values))).otherwise(F.array(F.struct(F.lit(None).cast("string").alias("v"))))))
        match, group = F.regexp_extract("content", pattern, 0), F.regexp_extract("content", pattern, 1)
        filled = F.when(F.col("_v.v").isNotNull() & (group != ""), F.replace("content", match, F.replace(match, group, F.col("_v.v")))).otherwise(F.col("content"))
        params = F.when(F.col("_v.v").isNotNull(), F.map_concat(F.map_filter("params", lambda k, _: k != name), F.create_map(F.lit(name), F.col("_v.v")))).otherwise(F.col("params"))
        return many.withColumn("content", filled).withColumn("params", params).drop("_v")

    return run


def filter_stage(keep: Column) -> Stage:
    """Contents whose parameters meet a condition, such as one of ``lookup.condition``."""
    return lambda contents: contents.where(keep)


def layout_stage(fragments: Sequence[tuple[str, str]], variants: dict[str, dict[str, str]], name: str) -> Stage:
    """Known fragments (text, tag) become their tag, then each variant writes its own text for every tag.

    ``variants`` is a value of parameter ``name`` -> tag -> text; there are as many outputs per content. Contents without
    a fragment pass as they are.
    """

    def run(contents: DataFrame) -> DataFrame:
        tagged = reduce(lambda text, f: F.replace(text, F.lit(f[0]), F.lit(f[1])), fragments, F.col("content"))
        outs = [F.struct(F.lit(v).alias("v"), reduce(lambda text, f: F.replace(text, F.lit(f[0]), F.lit(f[1])), texts.items(), F.col("_t")).alias("c")) for v, texts in variants.items()]
        known = F.col("_t") != F.col("content")
        plain = F.array(F.struct(F.lit(None).cast("string").alias("v"), F.col("content").alias("c")))
        many = contents.withColumn("_t", tagged).withColumn("_o", F.explode(F.when(known, F.array(*outs)).otherwise(plain)))
        params = F.when(F.col("_o.v").isNotNull(), F.map_concat(F.map_filter("params", lambda k, _: k != name), F.create_map(F.lit(name), F.col("_o.v")))).otherwise(F.col("params"))
        return many.withColumn("params", params).withColumn("content", F.col("_o.c")).drop("_t", "_o")

    return run


def range_values(spec: Sequence) -> list[str | None]:
    """Values of a parameter: listed ones, and (low, high) pairs of integers for all between, ends included."""
    out: list[str | None] = []
    for x in spec:
        out += [str(i) for i in range(x[0], x[1] + 1)] if isinstance(x, tuple) else [x]
    return out


def template_stage(name: str, pattern: str, template: str, values: Sequence) -> Stage:
    """One content per value of a parameter: each match of the pattern becomes the template, with ``$n`` its groups and ``{value}`` the value.

    ``values`` as in ``range_values``; a null value leaves the text and the parameter null. Contents without a match pass once.
    """
    listed = range_values(values)

    def run(contents: DataFrame) -> DataFrame:
        found = F.col("content").rlike(pattern)
        outs = [F.struct(F.lit(v).cast("string").alias("v"), (F.regexp_replace("content", pattern, template.replace("{value}", v)) if v is not None else F.col("content")).alias("c")) for v in listed]
        plain = F.array(F.struct(F.lit(None).cast("string").alias("v"), F.col("content").alias("c")))
        many = contents.withColumn("_o", F.explode(F.when(found, F.array(*outs)).otherwise(plain)))
        params = F.when(F.col("_o.v").isNotNull(), F.map_concat(F.map_filter("params", lambda k, _: k != name), F.create_map(F.lit(name), F.col("_o.v")))).otherwise(F.col("params"))
        return many.withColumns({"params": params, "content": F.col("_o.c")}).drop("_o")

    return run


def _lower_escapes(text: Column) -> Column:
    """Percent-encoded as in a URL's part, escapes in lower case."""
    coded = F.url_encode(text)
    for plain, code in ((" ", "+"), ("!", "%21"), ("'", "%27"), ("(", "%28"), (")", "%29"), ("~", "%7E")):
        coded = F.replace(coded, F.lit(code), F.lit("%20" if plain == " " else plain))
    pieces = F.split(coded, "%")
    return F.array_join(F.transform(pieces, lambda p, i: F.when(i == 0, p).otherwise(F.concat(F.lower(F.substring(p, 1, 2)), F.substring(p, F.lit(3), F.length(p))))), "%")


def tracking_stage(path: str | None = None, query: str | None = None, default_path: str | None = None) -> Stage:
    """Puts the addresses of a page's tracking images into one form, so that pages that differ in them alone become equal.

    source becomes www; the page's address loses its case, host and referrer, and its query as ``query`` says: "strip", "params" for the content's own parameters, or as it is; a
    directory gets ``default_path``; p its case, or becomes ``path``; the referrer goes. Pages without the image stay.
    """
    from arkspark.functions.scalars import bind
    from arkspark.operators.enrichment import TOOLBAR, TRACKING_IMAGES, _decoded

    same_host = "h=www%2Emicrosoft%2Ecom"

    def address(part: Column, params: Column) -> Column:
        def new(content: Column) -> Column:
            base, rest = F.substring_index(content, "?", 1), F.get(F.split(content, r"\?"), F.lit(1))
            inner = F.array_join(F.transform(F.split(rest, "&"), lambda s: F.when(s.startswith("h="), F.lit(same_host)).when(s.startswith("r=") & (F.length(s) > 2), F.lit("r=")).otherwise(s)), "&")
            full = F.when(base.endswith("/") & F.lit(default_path is not None), F.concat(base, F.lit(default_path or ""))).otherwise(base)
            toolbar = (base == TOOLBAR) & (F.coalesce(rest, F.lit("")) != "")
            if query == "params":
                own = param_key(F.map_filter(params, lambda _, v: v.isNotNull()))
                plain = F.concat(F.lit("URI="), _lower_escapes(F.concat(F.lower(full), F.when(own != "", F.concat(F.lit("?"), own)).otherwise(""))))
            else:
                bare = F.coalesce(rest, F.lit("")) == ""
                lowered = F.when(content != F.lower(content), F.concat(F.lit("URI="), _lower_escapes(F.lower(content)))).otherwise(part)
                plain = F.when(bare, lowered).otherwise(F.concat(F.lit("URI="), _lower_escapes(F.lower(full))) if query == "strip" else part)
            return F.when(toolbar, F.concat(F.lit("URI="), _lower_escapes(F.concat(base, F.lit("?"), inner)))).otherwise(plain)

        return bind(_decoded(F.substring(part, F.lit(5), F.length(part))), new)

    def part(p: Column, params: Column) -> Column:
        shown = F.when(p == "p=library_toolbar_3.0", p).otherwise(F.lit(f"p={path}") if path else F.lower(p))
        return F.when(p.startswith("source="), F.when(p == "source=localhost", p).otherwise(F.lit("source=www"))).when(p.startswith("URI="), address(p, params)).when(p.startswith("p="), shown).when(p.startswith("r="), F.lit(None)).otherwise(p)

    def run(contents: DataFrame) -> DataFrame:
        text = F.col("content")
        for pattern, separator in TRACKING_IMAGES:
            def cleaned(url: Column, separator: str = separator) -> Column:
                parts = F.array_compact(F.transform(F.split(F.get(F.split(url, r"\?"), F.lit(1)), separator), lambda p: part(p, F.col("params"))))
                return F.concat(F.substring_index(url, "?", 1), F.lit("?"), F.array_join(parts, separator))

            contents = contents.withColumn("_url", F.regexp_extract(text, pattern, 1))
            new = F.when((F.col("_url") != "") & F.col("_url").contains("?"), F.replace(text, F.col("_url"), cleaned(F.col("_url")))).otherwise(text)
            contents = contents.withColumn("content", F.when(text.contains("function footerjs(doc)"), new).otherwise(text)).drop("_url")
        return contents

    return run


#: Stages by name, each with the options it takes; those without a default are required.
STAGES: dict[str, tuple[Callable[..., Stage], frozenset[str], frozenset[str]]] = {
    "regex": (regex_stage, frozenset(("pattern", "template")), frozenset(("case",))),
    "param": (param_stage, frozenset(("name", "pattern", "values")), frozenset()),
    "template": (template_stage, frozenset(("name", "pattern", "template", "values")), frozenset()),
    "filter": (filter_stage, frozenset(("keep",)), frozenset()),
    "layout": (layout_stage, frozenset(("fragments", "variants", "name")), frozenset()),
    "tracking": (tracking_stage, frozenset(), frozenset(("path", "query", "default_path"))),
}


def stages_of(spec: Sequence[dict]) -> list[Stage]:
    """Stages of a configuration [{"type": name, option: value, ...}]; unknown names and options, and missing ones, are errors."""
    out = []
    for entry in spec:
        options = {k: v for k, v in entry.items() if k != "type"}
        if entry.get("type") not in STAGES:
            raise ValueError(f"unknown stage {entry.get('type')!r}")
        make, required, optional = STAGES[entry["type"]]
        if missing := required - options.keys():
            raise ValueError(f"stage {entry['type']!r} lacks {sorted(missing)}")
        if unknown := options.keys() - required - optional:
            raise ValueError(f"stage {entry['type']!r} has no {sorted(unknown)}")
        out.append(make(**options))
    return out


def raw_outputs(captures: DataFrame, links: DataFrame) -> DataFrame:
    """``captures`` (sha, type) whose own content isn't among the outputs, or that aren't ok: they are written as they were."""
    made = links.select(F.col("sha").alias("_sha")).distinct()
    return captures.where(F.coalesce(F.col("type") != "ok", F.lit(True))).unionByName(captures.where(F.col("type") == "ok").join(made, F.col("sha") == F.col("_sha"), "left_anti"))


def transformed_captures(captures: DataFrame, links: DataFrame) -> DataFrame:
    """``captures`` (ord, sha, modified14, ...) of the outputs they became: output_sha, param_key, original_sha where the content changed, and then no modified14."""
    out = captures.join(links.select(F.col("source_sha").alias("_source"), F.col("sha").alias("output_sha"), "param_key"), F.col("sha") == F.col("_source")).drop("_source")
    changed = F.col("output_sha") != F.col("sha")
    return out.withColumns({"original_sha": F.when(changed, F.col("sha")), "modified14": F.when(~changed, F.col("modified14"))})


def run_stages(sources: DataFrame, stages: Sequence[Stage]) -> tuple[DataFrame, DataFrame]:
    """(contents, links) of sources (sha, content) after all stages.

    A null content counts as empty. After each stage equal contents with equal parameters become one row. links (source_sha, sha, param_key) says which
    sources an output comes from; as rows, not lists, since a thousand sources may fold into one content.
    """
    contents = sources.select("sha", F.lit("").alias("param_key"), F.expr("cast(map() as map<string, string>)").alias("params"), F.coalesce("content", F.lit("")).alias("content")).dropDuplicates(["sha"])
    links = contents.select(F.col("sha").alias("source_sha"), "sha", "param_key")
    for stage in stages:
        out = stage(contents.withColumn("old_sha", F.col("sha")).withColumn("old_key", F.col("param_key")))
        out = out.withColumn("sha", F.sha2("content", 256)).withColumn("param_key", param_key(F.col("params")))
        steps = out.select("old_sha", "old_key", "sha", "param_key").distinct()
        links = links.withColumnsRenamed({"sha": "old_sha", "param_key": "old_key"}).join(steps, ["old_sha", "old_key"]).select("source_sha", "sha", "param_key").distinct()
        contents = out.dropDuplicates(["sha", "param_key"]).select("sha", "param_key", "params", "content")
    return contents, links
