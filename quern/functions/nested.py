"""List, map, struct, union, enum and variant functions.  List positions count from 1."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions.registry import FUNCTIONS, alias, call, col, let, register


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, v: s + v)


def _norm(a: Column) -> Column:
    return F.sqrt(_dot(a, a))


@register("list_inner_product", "list_dot_product", "array_inner_product", "array_dot_product")
def inner_product(a, b):
    return _dot(a, b)


@register("list_negative_inner_product", "list_negative_dot_product", "array_negative_inner_product", "array_negative_dot_product")
def negative_inner_product(a, b):
    return -_dot(a, b)


@register("list_cosine_similarity", "array_cosine_similarity")
def cosine_similarity(a, b):
    return _dot(a, b) / (_norm(a) * _norm(b))


@register("list_cosine_distance", "array_cosine_distance", "<=>")
def cosine_distance(a, b):
    return 1 - cosine_similarity(a, b)


@register("list_distance", "array_distance", "<->")
def distance(a, b):
    return F.sqrt(F.aggregate(F.zip_with(col(a), col(b), lambda x, y: (x.cast("double") - y) * (x.cast("double") - y)), F.lit(0.0), lambda s, v: s + v))


@register()
def array_cross_product(a, b):
    a, b = col(a), col(b)
    g = lambda x, i: F.get(x, F.lit(i))
    return F.array(*[g(a, i) * g(b, j) - g(a, j) * g(b, i) for i, j in ((1, 2), (2, 0), (0, 1))])


@register("list_value", "list_pack", "array_value", "unpivot_list")
def list_value(*xs):
    return F.array(*map(col, xs))


@register()
def flatten(x):
    """Null sublists count as empty."""
    return F.flatten(F.filter(col(x), lambda y: y.isNotNull()))


@register("range")
def range_(a, b, step: int = 1):
    """Without its end; empty if the step leads away from it."""
    a, b = col(a).cast("long"), col(b).cast("long")
    last = b - (1 if step > 0 else -1)
    ok = (a < b) if step > 0 else (a > b)
    return F.when(ok, F.sequence(a, F.when(ok, last).otherwise(a), F.lit(step).cast("long"))).otherwise(F.array().cast("array<bigint>"))


@register()
def generate_series(a, b, step: int = 1):
    a, b = col(a).cast("long"), col(b).cast("long")
    ok = (a <= b) if step > 0 else (a >= b)
    return F.when(ok, F.sequence(a, F.when(ok, b).otherwise(a), F.lit(step).cast("long"))).otherwise(F.array().cast("array<bigint>"))


@register("list_distinct", "array_distinct")
def list_distinct(x):
    return F.array_compact(F.array_distinct(col(x)))


@register("list_unique", "array_unique")
def list_unique(x):
    return F.size(list_distinct(x)).cast("long")


@register("list_filter", "array_filter", "filter")
def list_filter(x, fn):
    """fn(element) or fn(element, position)."""
    return F.filter(col(x), (lambda e, i: fn(e, i + 1)) if fn.__code__.co_argcount == 2 else fn)


@register("list_transform", "array_transform", "list_apply", "array_apply", "apply")
def list_transform(x, fn):
    return F.transform(col(x), (lambda e, i: fn(e, i + 1)) if fn.__code__.co_argcount == 2 else fn)


@register("list_reduce", "array_reduce", "reduce")
def list_reduce(x, fn, initial=None):
    """Without an initial value the first element is it; then an empty list fails."""
    x = col(x)
    if initial is not None:
        return F.aggregate(x, col(initial), fn)
    return F.aggregate(F.slice(x, F.lit(2), F.greatest(F.size(x) - 1, F.lit(0))), F.element_at(x, 1), fn)


def _order(a: Column, b: Column, descending: bool, nulls_first: bool) -> Column:
    nulls = -1 if nulls_first else 1
    less = 1 if descending else -1
    return F.when(a.isNull() & b.isNull(), 0).when(a.isNull(), nulls).when(b.isNull(), -nulls).when(a < b, less).when(a > b, -less).otherwise(0)


@register("list_sort", "array_sort")
def list_sort(x, order: str = "ASC", nulls: str = "NULLS LAST"):
    return F.array_sort(col(x), lambda a, b: _order(a, b, order == "DESC", nulls == "NULLS FIRST"))


@register("list_reverse_sort", "array_reverse_sort")
def list_reverse_sort(x, nulls: str = "NULLS LAST"):
    return list_sort(x, "DESC", nulls)


@register("list_grade_up", "array_grade_up", "grade_up")
def list_grade_up(x):
    x = col(x)
    pairs = F.transform(x, lambda e, i: F.struct(e.alias("e"), (i + 1).alias("i")))
    by = lambda a, b: F.when(_order(a["e"], b["e"], False, False) != 0, _order(a["e"], b["e"], False, False)).otherwise(F.when(a["i"] < b["i"], -1).otherwise(1))
    return F.transform(F.array_sort(pairs, by), lambda p: p["i"].cast("long"))


@register("list_has_all", "array_has_all", "@>")
def list_has_all(a, b):
    return F.size(F.array_except(F.array_compact(col(b)), col(a))) == 0


@register("<@")
def contained(a, b):
    return list_has_all(b, a)


@register("list_has_any", "array_has_any", "&&")
def list_has_any(a, b):
    return F.arrays_overlap(F.array_compact(col(a)), F.array_compact(col(b)))


@register("list_contains", "list_has", "array_contains", "array_has")
def list_contains(x, e):
    return F.exists(col(x), lambda y: F.coalesce(y == (e if isinstance(e, Column) else F.lit(e)), F.lit(False)))


@register("list_position", "list_indexof", "array_position", "array_indexof")
def list_position(x, e):
    """Null where absent."""
    found = F.array_position(col(x), e)
    return F.when(found > 0, found).cast("int")


@register("list_extract", "list_element", "array_extract")
def list_extract(x, i: int):
    return F.lit(None) if i == 0 else F.try_element_at(col(x), F.lit(i))


@register("list_slice", "array_slice")
def list_slice(x, begin: int | None, end: int | None, step: int = 1):
    """From begin to end, both included; negative ones count from the end."""
    x = col(x)
    n = F.size(x)
    place = lambda p, default: default if p is None else (F.lit(p) if p >= 0 else n + p + 1)
    first, last = F.greatest(place(begin, F.lit(1)), F.lit(1)), F.least(place(end, n), n)
    return F.filter(x, lambda _, i: (i + 1 >= first) & (i + 1 <= last) & ((i + 1 - first) % step == 0))


@register("list_resize", "array_resize")
def list_resize(x, n: int, value=None):
    x = col(x)
    fill = F.array_repeat(F.lit(value), n)
    return F.slice(F.concat(x, fill), 1, n)


@register("list_select", "array_select")
def list_select(x, places):
    return F.transform(col(places), lambda i: F.try_element_at(col(x), i.cast("int")))


@register("list_where", "array_where")
def list_where(x, mask):
    return F.transform(F.filter(F.arrays_zip(col(x).alias("x"), col(mask).alias("m")), lambda z: z["m"]), lambda z: z["x"])


@register("list_zip", "array_zip")
def list_zip(*xs):
    return F.arrays_zip(*map(col, xs))


@register("list_concat", "list_cat", "array_concat", "array_cat")
def list_concat(*xs):
    """Null lists count as empty."""
    return F.concat(*[F.coalesce(col(x), F.array()) for x in xs])


@register("list_append", "array_append", "array_push_back")
def list_append(x, e):
    return F.array_append(col(x), e)


@register("list_prepend", "array_prepend", "array_push_front")
def list_prepend(e, x):
    return F.array_prepend(col(x), e)


@register("array_pop_back")
def array_pop_back(x):
    return F.slice(col(x), F.lit(1), F.greatest(F.size(col(x)) - 1, F.lit(0)))


@register("array_pop_front")
def array_pop_front(x):
    return F.filter(col(x), lambda _, i: i > 0)


@register("list_intersect", "array_intersect")
def list_intersect(a, b):
    return F.array_compact(F.array_intersect(col(a), col(b)))


@register("list_reverse", "array_reverse")
def list_reverse(x):
    return F.reverse(col(x))


@register("array_length")
def array_length(x):
    return F.size(col(x)).cast("long")


@register("array_to_string", "list_to_string")
def array_to_string(x, sep: str):
    return F.array_join(F.transform(col(x), lambda e: e.cast("string")), sep)


_SUM = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v)


def _power(x: Column, mean: Column, k: int) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda s, v: s + F.pow(v - mean, F.lit(k)))


def _moment(x: Column, name: str) -> Column:
    """Of a list of doubles without nulls; the mean and the second moment are worked out once."""
    size = F.size(x)
    n, fewer = F.when(size > 0, size), F.when(size > 1, size - 1)
    mean = _SUM(x) / n
    if name in ("avg", "mean"):
        return mean

    def found(mean: Column, m2: Column) -> Column:
        if name == "var_pop":
            return m2 / n
        if name in ("var_samp", "variance"):
            return m2 / fewer
        if name == "stddev_pop":
            return F.sqrt(m2 / n)
        if name in ("stddev_samp", "stddev"):
            return F.sqrt(m2 / fewer)
        if name == "sem":
            return F.sqrt(m2 / n) / F.sqrt(n)
        count, var = size.cast("double"), m2 / n
        if name == "skewness":
            return F.when(size > 2, _power(x, mean, 3) / n / F.pow(var, F.lit(1.5)) * F.sqrt(count * (count - 1)) / (count - 2))
        flat = _power(x, mean, 4) / n / F.when(var > 0, var * var)
        if name == "kurtosis_pop":
            return F.when(size > 1, flat - 3)
        return F.when(size > 3, (count - 1) * ((count + 1) * flat - 3 * (count - 1)) / ((count - 2) * (count - 3)))

    return let(mean, lambda m: let(_power(x, m, 2), lambda m2: found(m, m2)))


def _median(x: Column) -> Column:
    """Of a list of doubles without nulls."""
    at = lambda s, i: F.get(s, i.cast("int"))
    return let(F.array_sort(x), lambda s: (at(s, F.floor((F.size(s) - 1) / 2)) + at(s, F.floor(F.size(s) / 2))) / 2)


def _counted(some: Column, name: str) -> Column:
    """Of a list without nulls, by how often each value occurs."""
    times = lambda v: F.size(F.filter(some, lambda e: e == v))
    kinds = F.array_distinct(some)
    if name == "mode":  # of equally common values the first
        return F.array_max(F.transform(kinds, lambda v, i: F.struct(times(v).alias("n"), (-i).alias("i"), v.alias("v"))))["v"]
    if name == "histogram":
        return F.map_from_entries(F.transform(F.array_sort(kinds), lambda v: F.struct(v.alias("key"), times(v).cast("long").alias("value"))))
    return _SUM(F.transform(F.transform(kinds, lambda v: times(v) / F.size(some)), lambda share: -share * F.log2(share)))


_MOMENTS = "avg mean var_pop var_samp variance stddev_pop stddev_samp stddev sem skewness kurtosis kurtosis_pop".split()


@register("list_aggregate", "list_aggr", "array_aggregate", "array_aggr", "aggregate")
def list_aggregate(x, name: str, *args):
    """An aggregate over the list's elements; nulls are skipped, as over rows."""
    x = col(x)
    if name in ("first", "last"):
        return F.try_element_at(x, F.lit(1 if name == "first" else -1))
    some = F.array_compact(x)
    doubles = lambda a: F.transform(a, lambda e: e.cast("double"))
    if name in _MOMENTS:
        return let(doubles(some), lambda d: _moment(d, name))
    if name == "median":
        return _median(doubles(some))
    if name == "mad":
        return let(doubles(some), lambda d: let(_median(d), lambda middle: _median(F.transform(d, lambda v: F.abs(v - middle)))))
    if name in ("mode", "entropy", "histogram"):
        return let(some, lambda a: _counted(a, name))
    if name in ("bit_and", "bit_or", "bit_xor"):
        join = {"bit_and": lambda s, v: s.bitwiseAND(v), "bit_or": lambda s, v: s.bitwiseOR(v), "bit_xor": lambda s, v: s.bitwiseXOR(v)}[name]
        return let(some, lambda a: F.when(F.size(a) != 0, F.aggregate(F.transform(a, lambda e: e.cast("long")), F.lit(-1 if name == "bit_and" else 0).cast("long"), join)))
    found = {
        "min": F.array_min, "max": F.array_max, "count": lambda a: F.size(a).cast("long"), "any_value": lambda a: F.try_element_at(a, F.lit(1)),
        "sum": lambda a: F.when(F.size(a) != 0, _SUM(doubles(a))), "product": lambda a: F.when(F.size(a) != 0, F.aggregate(doubles(a), F.lit(1.0), lambda s, v: s * v)),
        "string_agg": lambda a: F.when(F.size(a) != 0, F.array_join(F.transform(a, lambda e: e.cast("string")), args[0] if args else ",")),
        "approx_count_distinct": lambda a: F.size(F.array_distinct(a)).cast("long"),
        "bool_and": lambda a: F.when(F.size(a) != 0, F.forall(a, lambda e: e)), "bool_or": lambda a: F.when(F.size(a) != 0, F.exists(a, lambda e: e)),
    }
    return let(some, found[name])


for _n in "avg var_samp var_pop stddev_pop stddev_samp sum product min max count first last any_value median string_agg bool_and bool_or approx_count_distinct mean sem mode mad entropy histogram skewness kurtosis kurtosis_pop bit_and bit_or bit_xor".split():
    FUNCTIONS[f"list_{_n}"] = lambda x, *a, _n=_n: list_aggregate(x, _n, *a)


@register("map")
def map_(keys, values):
    return F.map_from_arrays(col(keys), col(values))


@register("map_from_entries")
def map_from_entries(x):
    return F.map_from_entries(col(x))


@register("map_concat")
def map_concat(*ms):
    """A later map's value for a key wins."""
    out = col(ms[0])
    for m in ms[1:]:
        out = F.map_concat(_without(out, col(m)), col(m))
    return out


def _without(m, other):
    return F.map_filter(m, lambda k, _: ~F.map_contains_key(other, k))


@register("map_extract", "element_at")
def map_extract(m, k):
    """A list of the value, empty where the key is absent."""
    m, k = col(m), F.lit(k)
    return F.when(F.map_contains_key(m, k), F.array(F.try_element_at(m, k))).otherwise(F.array_except(F.map_values(m), F.map_values(m)))


@register("map_extract_value")
def map_extract_value(m, k):
    return F.try_element_at(col(m), F.lit(k))


@register("map_contains")
def map_contains(m, k):
    return F.map_contains_key(col(m), F.lit(k))


@register("map_contains_value")
def map_contains_value(m, v):
    return F.array_contains(F.map_values(col(m)), F.lit(v))


@register("map_contains_entry")
def map_contains_entry(m, k, v):
    return F.coalesce(F.try_element_at(col(m), F.lit(k)) == F.lit(v), F.lit(False))


@register("generate_subscripts")
def generate_subscripts(x):
    """A row per element: its place."""
    return F.explode(F.when(F.size(col(x)) > 0, F.sequence(F.lit(1), F.size(col(x)))))


@register("array_to_string_comma_default")
def array_to_string_comma_default(x, sep: str = ","):
    return F.array_join(col(x), sep)


@register("variant_normalize")
def variant_normalize(v):
    """The same value with its fields in the order of their names."""
    return F.parse_json(F.to_json(col(v)))


for _n in "map_keys map_values map_entries".split():
    FUNCTIONS[_n] = lambda m, _f=getattr(F, _n): _f(col(m))
FUNCTIONS["cardinality"] = lambda m: F.size(col(m)).cast("long")


@register("switch")
def switch(key, cases: dict, default=None):
    out = F.lit(default)
    for k, v in reversed(list(cases.items())):
        out = F.when(col(key) == k, v).otherwise(out)
    return out


@register("struct_pack", "row")
def struct_pack(**fields):
    return F.struct(*[col(v).alias(k) for k, v in fields.items()])


@register("struct_extract")
def struct_extract(s, name: str):
    return col(s)[name]


@register("struct_extract_at")
def struct_extract_at(s, i: int, names: list[str]):
    return col(s)[names[i - 1]]


@register("struct_insert", "struct_update")
def struct_insert(s, **fields):
    out = col(s)
    for k, v in fields.items():
        out = out.withField(k, col(v))
    return out


@register("struct_concat")
def struct_concat(*parts: tuple[Column, list[str]]):
    """Each part: a struct and its field names."""
    return F.struct(*[col(s)[n].alias(n) for s, names in parts for n in names])


@register("struct_keys")
def struct_keys(names: list[str]):
    return F.array(*map(F.lit, names))


@register("struct_values")
def struct_values(s, names: list[str]):
    return F.struct(*[col(s)[n].alias(f"v{i + 1}") for i, n in enumerate(names)])


@register("struct_contains", "struct_has")
def struct_contains(s, value, names: list[str]):
    return F.array_contains(F.array(*[col(s)[n] for n in names]), value)


@register("struct_position", "struct_indexof")
def struct_position(s, value, names: list[str]):
    return list_position(F.array(*[col(s)[n] for n in names]), value)


@register("remap_struct")
def remap_struct(s, mapping: dict[str, str], defaults: dict | None = None):
    """A struct of new fields from old ones, and of defaults."""
    return F.struct(*[col(s)[old].alias(new) for new, old in mapping.items()], *[F.lit(v).alias(k) for k, v in (defaults or {}).items()])


# A union is a struct of its tag and a field per member.
@register("union_value")
def union_value(tag: str, value, members: dict[str, str]):
    return F.struct(F.lit(tag).alias("tag"), *[(col(value) if m == tag else F.lit(None)).cast(t).alias(m) for m, t in members.items()])


@register("union_tag")
def union_tag(u):
    return col(u)["tag"]


@register("union_extract")
def union_extract(u, member: str):
    return F.when(col(u)["tag"] == member, col(u)[member])


# An enum is a string and its domain.
@register("enum_code")
def enum_code(x, domain: list[str]):
    return F.array_position(F.array(*map(F.lit, domain)), col(x)) - 1


@register("enum_first")
def enum_first(domain: list[str]):
    return F.lit(domain[0])


@register("enum_last")
def enum_last(domain: list[str]):
    return F.lit(domain[-1])


@register("enum_range")
def enum_range(domain: list[str]):
    return F.array(*map(F.lit, domain))


@register("enum_range_boundary")
def enum_range_boundary(a: str, b: str, domain: list[str]):
    return F.array(*map(F.lit, domain[domain.index(a) : domain.index(b) + 1]))


@register("variant_extract")
def variant_extract(v, path: str, kind: str):
    return F.variant_get(col(v), path, kind)


@register("variant_typeof")
def variant_typeof(v):
    return F.schema_of_variant(col(v))


alias("list_aggregate", "list_agg")
__all__ = ["call"]
