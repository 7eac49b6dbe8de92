"""Evidence from text and event series: usage scans, nearest and containing matches, scores with ties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def word_usage(docs: DataFrame, *, keys: list[str], text: str, pattern: str) -> DataFrame:
    """(keys, word, n_uses) of the first group of a pattern; counts combine before the shuffle."""
    words = docs.select(*keys, F.explode(F.expr(f"regexp_extract_all({text}, r'{pattern}', 1)")).alias("word"))
    return words.groupBy(*keys, "word").agg(F.count("*").alias("n_uses"))


def nearest_after(
    anchors: DataFrame, points: DataFrame, *, key: str, time: str, anchor_id: str, point_id: str, before: int, after: int
) -> DataFrame:
    """For each anchor the points nearest to it, ties kept, from ``before`` seconds ahead of it up to the
    next anchor of its key, or ``after`` seconds behind it where there is none.

    Times are whole seconds. Anchors and points meet in buckets as wide as the reach, so the join is an
    equi-join and a key with a long history spreads over many tasks.
    """
    width = max(before, after)
    ends = F.lead(time).over(Window.partitionBy(key).orderBy(time, anchor_id))
    spans = anchors.select(
        key, F.col(anchor_id).alias("anchor"), F.col(time).alias("at"), F.least(F.coalesce(ends, F.col(time) + after), F.col(time) + after).alias("until")
    )
    buckets = F.explode(F.sequence(F.floor((F.col("at") - before) / width), F.floor(F.col("until") / width))).alias("bucket")
    spans = spans.select("*", buckets)
    own = points.select(key, F.col(point_id).alias("point"), F.col(time).alias("t"), F.floor(F.col(time) / width).alias("bucket"))
    near = spans.join(own, [key, "bucket"]).where((F.col("t") >= F.col("at") - before) & (F.col("t") < F.col("until")))
    near = near.select(key, "anchor", "point", F.abs(F.col("t") - F.col("at")).alias("distance"))
    best = near.groupBy("anchor").agg(F.min("distance").alias("distance"))
    return near.join(best, ["anchor", "distance"]).select(key, "anchor", "point", "distance")


def as_of(rows: DataFrame, *, key: str, order: list[str], is_anchor: Column, is_point: Column, value: Column, time: str, within: int) -> DataFrame:
    """For each anchor row the latest point before it, if not older than ``within``; nulls without one.

    One sort over the union of both, no range join.
    """
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(is_point, F.struct(value.alias("value"), F.col(time).alias("t"))), ignorenulls=True).over(w)
    found = rows.withColumn("_last", last).where(is_anchor)
    fresh = F.col(time) - F.col("_last.t") <= within
    return found.select(
        *rows.columns, F.when(fresh, F.col("_last.value")).alias("matched"), F.when(fresh, F.col(time) - F.col("_last.t")).alias("age")
    )


def best_scores(pairs: DataFrame, *, key: list[str], score: str) -> DataFrame:
    """Rows at the top score of each key, all ties."""
    best = pairs.groupBy(*key).agg(F.max(score).alias("_best"))
    return pairs.join(best, key).where(F.col(score) == F.col("_best")).drop("_best")


def unambiguous(rows: DataFrame, *, keys: list[str], value: list[str], pick: str) -> DataFrame:
    """Keys with a single distinct value, and the smallest ``pick`` that has it."""
    kinds = rows.groupBy(*keys, *value).agg(F.min(pick).alias(pick))
    found = kinds.groupBy(*keys).agg(F.count("*").alias("n_values"), F.first(F.struct(*value)).alias("v"), F.min(pick).alias(pick))
    return found.where("n_values = 1").select(*keys, *(F.col(f"v.{c}").alias(c) for c in value), pick)


def owners(modules: DataFrame, members: DataFrame, *, module: str, attributes: str, name: str, wanted: str) -> DataFrame:
    """The only module whose attributes meet each name's members; null where none or several do."""
    own = modules.select(module, F.explode(attributes).alias("member")).distinct()
    asked = members.select(name, F.explode(wanted).alias("member")).distinct()
    hits = asked.join(own, "member").select(name, module).distinct().groupBy(name).agg(F.count("*").alias("n"), F.min(module).alias("m"))
    return members.select(name).distinct().join(hits, name, "left").select(name, F.when(F.col("n") == 1, F.col("m")).alias("owner"))


def expand_families(signatures: DataFrame, *, name: str, params: str, result: str | None = None) -> DataFrame:
    """Each signature with the longer ones of its name (and result) that begin with it.

    By an index of beginnings: a row for each (name, length, hash of the first parameters) of a longer signature meets the
    signatures of that length by equality, so signatures of a name are not held against each other.
    """
    same = [name] if result is None else [name, result]
    own = signatures.select(*same, params).distinct()
    short = own.select(*same, F.col(params).alias("short"), F.size(params).alias("_n"), F.xxhash64(params).alias("_h"))
    cuts = F.explode(F.when(F.size(params) > 0, F.sequence(F.lit(0), F.size(params) - 1)))
    longer = own.select(*same, F.col(params).alias("longer"), cuts.alias("_n"))
    longer = longer.withColumn("_start", F.slice("longer", F.lit(1), F.col("_n"))).withColumn("_h", F.xxhash64("_start"))
    both = short.join(longer, [*same, "_n", "_h"])
    return both.where(F.col("_start") == F.col("short")).select(*same, "short", "longer")


#: What stands for a type that is not known.
ANY = "Any"


def fit_score(params: Column, kinds: Column) -> Column:
    """How well the kinds of a call's arguments fit a signature's parameters."""

    def one(pair: Column) -> Column:
        expected, observed = pair["p"], pair["k"]
        unknown = F.when(observed == ANY, F.when(expected == ANY, 0).otherwise(-1)).when(expected == ANY, 0)
        return F.coalesce(unknown, F.when((expected == observed) | ((observed == "int") & (expected == "float")), 3).otherwise(-4))

    pairs = F.arrays_zip(F.slice(params, F.lit(1), F.size(kinds)).alias("p"), kinds.alias("k"))
    each = F.aggregate(pairs, F.lit(0), lambda total, pair: total + one(pair))
    missing = F.size(params) - F.size(kinds)
    return each + F.when(missing == 0, 10).otherwise(0) - missing


def choose_overloads(signatures: DataFrame, calls: DataFrame, *, name: str, params: str, result: str, kinds: str) -> DataFrame:
    """(name, result, params, chosen, required): the signatures that calls speak for, and how many arguments they need.

    A call that tells a kind counts; if none of a name does, all count. Each takes the signatures of its name, with as many
    parameters as it has arguments at least, that fit best, all ties. Those of one family with a chosen one (one
    begins with the other, of one result) stay beside it, not ``chosen``. A name without a call that fits keeps all.
    ``required`` is the least number of arguments of a name's counting calls, null if no fewer than the parameters.
    Different calls alone are scored, however often they occur.
    """
    own = signatures.select(name, result, params).distinct()
    shapes = calls.select(name, kinds).distinct().withColumn("_tells", F.exists(kinds, lambda k: k != ANY))
    told = shapes.groupBy(name).agg(F.max("_tells").alias("_any"))
    shapes = shapes.join(told, name).where("_tells OR NOT _any").drop("_any", "_tells")
    fits = own.join(shapes, name).where(F.size(params) >= F.size(kinds))
    best = best_scores(fits.withColumn("_score", fit_score(F.col(params), F.col(kinds))), key=[name, kinds], score="_score")
    chosen = best.select(name, result, params).distinct()
    pairs = expand_families(own, name=name, params=params, result=result)
    near = lambda one, other: pairs.join(chosen.withColumnRenamed(params, one), [name, result, one]).select(name, result, F.col(other).alias(params))
    beside = near("short", "longer").unionByName(near("longer", "short")).distinct().join(chosen, [name, result, params], "left_anti")
    unheard = own.join(chosen.select(name).distinct(), name, "left_anti")
    found = chosen.withColumn("chosen", F.lit(True)).unionByName(beside.unionByName(unheard).withColumn("chosen", F.lit(False)))
    least = shapes.groupBy(name).agg(F.min(F.size(kinds)).alias("_least"))
    required = F.when(F.col("_least") < F.size(params), F.col("_least"))
    return found.join(least, name, "left").select(name, result, params, "chosen", required.alias("required"))


_TOKEN = r"""[urbURB]{0,2}"(?:[^"\\\n]|\\.)*"|[urbURB]{0,2}'(?:[^'\\\n]|\\.)*'|#[^\n]*|[A-Za-z_][A-Za-z0-9_.]*[(]?|[0-9][0-9A-Za-z_.]*|==|\S"""
_FRAME = "struct<closer:string,name:string,kinds:array<string>,kind:string>"
_CALLS = "array<struct<name:string,kinds:array<string>>>"


def _kind_after(kind: Column, token: Column) -> Column:
    """The kind of an argument once a token has been read; ``word`` and ``sign`` are open still."""
    first = (
        F.when(token.rlike("^[urbURB]{0,2}[\"']."), "string")
        .when(token.rlike("^[0-9]"), "number")
        .when(token.isin("+", "-"), "sign")
        .when(token.isin("True", "False"), "bool")
        .when(token == "None", "none")
        .when(token.rlike("^[A-Za-z_].*[(]$"), "call")
        .when(token.rlike("^[A-Za-z_]"), "word")
        .otherwise("name")
    )
    return (
        F.when(kind == "", first)
        .when(kind.isin("keyword", "string", "call"), kind)
        .when((kind == "word") & (token == "="), "keyword")
        .when((kind == "sign") & token.rlike("^[0-9]"), "number")
        .otherwise("name")
    )


def call_shapes(docs: DataFrame, *, keys: list[str], text: str) -> DataFrame:
    """(keys, name, arity, kinds, n_calls) of calls: the kind of each argument is string, number, bool, none,
    keyword, call or name.

    Tokens are read one by one with a stack of what is open: round, square and curly brackets nest, and a comma
    parts the arguments of the innermost one. Strings, on one line, and comments part nothing. A bracket that does not
    close the innermost one is passed over; a call that is never closed is not told, those within it are.
    """
    frame = lambda closer, name, kinds, kind: F.struct(closer.alias("closer"), name.alias("name"), kinds.alias("kinds"), kind.alias("kind"))
    none = F.array().cast("array<string>")
    start = F.struct(F.array().cast(f"array<{_FRAME}>").alias("stack"), F.array().cast(_CALLS).alias("calls"))

    def step(state: Column, token: Column) -> Column:
        stack, calls = state["stack"], state["calls"]
        top, below = F.element_at(stack, -1), F.slice(stack, F.lit(1), F.size(stack) - 1)
        inside = F.size(stack) > 0
        ended = F.when(top["kind"] == "", top["kinds"]).otherwise(F.array_append(top["kinds"], F.when(top["kind"].isin("word", "sign"), "name").otherwise(top["kind"])))
        opens = token.rlike("^(?:[A-Za-z_][A-Za-z0-9_.]*)?[(]$") | token.isin("[", "{")
        closes = inside & (token == top["closer"])
        read = F.when(inside, F.array_append(below, frame(top["closer"], top["name"], top["kinds"], _kind_after(top["kind"], token)))).otherwise(stack)
        pushed = frame(
            F.when(token == "[", "]").when(token == "{", "}").otherwise(")"),
            F.when(token.rlike("^[A-Za-z_]"), F.regexp_extract(token, "^([^(]*)", 1)), none, F.lit(""),
        )
        commas = F.when(inside, F.array_append(below, frame(top["closer"], top["name"], ended, F.lit("")))).otherwise(stack)
        new_stack = F.when(token.startswith("#") | (token.isin(")", "]", "}") & ~closes), stack).when(closes, below).when(token == ",", commas).when(opens, F.array_append(read, pushed)).otherwise(read)
        done = F.array_append(calls, F.struct(top["name"].alias("name"), ended.alias("kinds")))
        return F.struct(new_stack.alias("stack"), F.when(closes & top["name"].isNotNull(), done).otherwise(calls).alias("calls"))

    tokens = F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))
    texts = docs.groupBy(*keys, text).agg(F.count("*").alias("_n"))  # equal texts are read once
    calls = texts.select(*keys, "_n", F.explode(F.aggregate(tokens, start, step, lambda state: state["calls"])).alias("call"))
    shapes = calls.select(*keys, "_n", "call.name", F.size("call.kinds").cast("long").alias("arity"), F.array_join("call.kinds", ",").alias("kinds"))
    return shapes.groupBy(*keys, "name", "arity", "kinds").agg(F.sum("_n").alias("n_calls"))


def _imports(text: Column) -> Column:
    """array<struct<module, name, alias>> of a text's imports."""
    empty_none = lambda c: F.when(c != "", c)

    def parts(line: Column) -> Column:
        source = F.regexp_extract(line, "^from\\s+([.A-Za-z0-9_]+)", 1)
        names = F.split(F.regexp_replace(F.regexp_extract(line, "import\\s+(.*)$", 1), "[()]", ""), ",")
        return F.transform(
            names,
            lambda part: F.struct(
                source.alias("source"), F.regexp_extract(part, "^\\s*([A-Za-z0-9_.*]+)", 1).alias("first"), F.regexp_extract(part, "\\sas\\s+([A-Za-z0-9_]+)\\s*$", 1).alias("alias")
            ),
        )

    lines = F.regexp_extract_all(text, F.lit(r"(?m)^[ \t]*((?:from[ \t]+[.A-Za-z0-9_]+[ \t]+)?import[ \t]+[^\n#;]+)"), F.lit(1))
    found = F.filter(F.flatten(F.transform(lines, parts)), lambda x: x["first"] != "")
    return F.transform(
        found,
        lambda x: F.struct(
            F.coalesce(empty_none(x["source"]), x["first"]).alias("module"), F.when(x["source"] != "", x["first"]).alias("name"), F.coalesce(empty_none(x["alias"]), x["first"]).alias("alias")
        ),
    )


def import_names(docs: DataFrame, *, keys: list[str], text: str) -> DataFrame:
    """(keys, module, name, alias) of imports: name is null for plain ones; a line each, of several names too."""
    return docs.select(*keys, F.explode(_imports(F.col(text))).alias("x")).select(*keys, "x.module", "x.name", "x.alias").distinct()


#: Texts whose imports and uses a task holds.
TEXTS = 50_000


def import_usage(docs: DataFrame, *, keys: list[str], text: str) -> DataFrame:
    """(keys, module, member, called): the members of imported modules that a text uses, under whatever alias, and whether
    it calls one.

    A module counts by its first name. Names that are imported from a module count as used; stars and relative modules
    say nothing. A text is read once, to rows of what it imports and what it uses; they meet in one group for each alias of a key.
    Partitions are as many as the texts ask for (TEXTS), so what a task holds does not grow with them.
    """
    parts = max(1, -(-docs.count() // TEXTS))
    texts = docs.select(*keys, text).repartition(parts, *keys, text)
    row = lambda kind, alias, module=None, member=None, called=None: F.struct(
        F.lit(kind).alias("kind"), alias.alias("_alias"), *((F.lit(None).cast(t) if c is None else c).alias(n) for n, c, t in (("module", module, "string"), ("member", member, "string"), ("called", called, "boolean")))
    )
    head = lambda x: F.substring_index(x["module"], ".", 1)
    named = F.filter("imports", lambda x: ~x["module"].startswith("."))
    plain = F.transform(F.filter(named, lambda x: x["name"].isNull()), lambda x: row("plain", F.when(x["alias"].contains("."), head(x)).otherwise(x["alias"]), head(x)))
    members = F.transform(F.filter(named, lambda x: x["name"] != "*"), lambda x: row("member", x["alias"], head(x), x["name"]))
    # the name is read, what follows is only looked at, so the parts of a.b.c are uses of a and of b
    of = lambda pattern: [F.regexp_extract_all(text, F.lit(pattern), F.lit(k)) for k in (1, 2, 3)]
    first, second, bracket = of(r"(?<![A-Za-z0-9_])([A-Za-z_]\w*)(?=[.]([A-Za-z_]\w*)(\s*[(])?)")
    dotted = F.transform(F.arrays_zip(first.alias("a"), second.alias("m"), bracket.alias("c")), lambda u: row("dotted", u["a"], None, u["m"], u["c"] != ""))
    bare = F.transform(F.regexp_extract_all(text, F.lit(r"(?<![A-Za-z0-9_])([A-Za-z_]\w*)\s*(?=[(])"), F.lit(1)), lambda u: row("bare", u))
    rows = texts.select("*", _imports(F.col(text)).alias("imports")).select(*keys, F.explode(F.array_distinct(F.concat(plain, members, dotted, bare))).alias("r")).select(*keys, "r.*")
    of_kind = lambda kind, *columns: F.collect_set(F.when(F.col("kind") == kind, F.struct(*columns)))
    met = rows.repartition(parts, *keys, "_alias").groupBy(*keys, "_alias").agg(
        of_kind("plain", "module").alias("modules"), of_kind("member", "module", "member").alias("members"), of_kind("dotted", "member", "called").alias("uses"), F.max(F.col("kind") == "bare").alias("bare")
    )
    use = lambda module, member, called: F.struct(module.alias("module"), member.alias("member"), called.alias("called"))
    through = F.flatten(F.transform("modules", lambda m: F.transform("uses", lambda u: use(m["module"], u["member"], u["called"]))))
    found = met.select(*keys, F.explode(F.concat(through, F.transform("members", lambda m: use(m["module"], m["member"], F.col("bare"))))).alias("f")).select(*keys, "f.*")
    return found.repartition(parts, *keys, "module", "member").groupBy(*keys, "module", "member").agg(F.max("called").alias("called"))


def match_names(rows: DataFrame, names: DataFrame, *, row: str, name: str) -> DataFrame:
    """Rows whose text is a name, or begins with it and a space and a slash: the part before `` /`` is joined."""
    own = rows.withColumn("_head", F.regexp_extract(row, "^(.*?)(?: /.*)?$", 1))
    return own.join(names.select(F.col(name).alias("_head")), "_head").select(*rows.columns, F.col("_head").alias("matched_name"))
