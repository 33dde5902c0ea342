"""Models by name: what they need, what they are and how they are written; and runs in order of need."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .context import Context
from .materialize import Table


@dataclass(frozen=True)
class Since:
    """From the newest ``mark`` that the model has written on, or from ``back`` (such as "1 HOUR") before it: rows whose
    ``read`` (an SQL expression, by default the mark's name) is greater, or as great unless ``strict``. ``like`` turns the
    mark, a literal, into what the rows are compared with, so that the bound reaches the scan."""

    mark: str
    read: str | None = None
    back: str | None = None
    strict: bool = False
    like: Callable[[Column], Column] = lambda x: x

    def apply(self, context: Context, df: DataFrame) -> DataFrame:
        newest = context.target.agg(F.max(self.mark).cast("string")).first()[0]
        if newest is None:
            return df
        kind = context.target.schema[self.mark].dataType
        bound = F.lit(newest).cast(kind)
        bound = self.like((bound - F.expr(f"INTERVAL {self.back}")).cast(kind) if self.back else bound)
        own = F.expr(self.read or self.mark)
        return df.filter(own > bound if self.strict else own >= bound)


@dataclass(frozen=True)
class Days:
    """From the start of the day ``back`` days before the run's on."""

    read: str
    back: int = 0

    def apply(self, context: Context, df: DataFrame) -> DataFrame:
        return df.filter(F.expr(self.read) >= context.today(self.back))


@dataclass(frozen=True)
class Hook:
    """After a commit: ``keep(context, rows, *inputs)`` gives the rows, by key, that stay."""

    keep: Callable[..., DataFrame]
    inputs: tuple[str, ...] = ()


@dataclass(frozen=True)
class Model:
    """``build(context, *inputs)`` gives the rows. kind: view, table, merge, insert (new keys alone), append or range.

    Where the model's table exists (and isn't written anew), ``reads`` bounds inputs by name, ``after`` bounds the rows
    built, and ``context.target`` is what was written before. ``hooks`` run after the commit.
    """

    name: str
    build: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    layer: str = "gold"
    kind: str = "view"
    key: tuple[str, ...] = ()
    update: tuple[str, ...] | None = None
    reads: Mapping[str, Since | Days] = field(default_factory=dict)
    after: Since | Days | None = None
    replaced: Callable[[Context], object] | None = None
    hooks: tuple[Hook, ...] = ()
    schema_change: str = "append"
    full_refresh: bool = True
    alias: str | None = None
    tags: frozenset[str] = frozenset()


class Registry:
    def __init__(self) -> None:
        self.models: dict[str, Model] = {}

    def model(self, *inputs: str, **how):
        """Decorator: registers the function under its name."""

        def add(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
            name = how.get("name", f.__name__)
            if name in self.models:
                raise ValueError(f"{name} is registered already")
            args = {k: v for k, v in how.items() if k != "name"}
            self.models[name] = Model(name, f, inputs, **(args | {"tags": frozenset(args.get("tags", ()))}))
            return f

        return add

    def select(self, spec: str) -> list[str]:
        """Names by "a,b" (both) and "a b" (either), of tag:x, layer:x, +name (with all it needs) or a name."""
        one = lambda s: {
            "tag": lambda v: {m.name for m in self.models.values() if v in m.tags},
            "layer": lambda v: {m.name for m in self.models.values() if m.layer == v},
        }[s.split(":")[0]](s.split(":")[1]) if ":" in s else self.needed([s[1:]]) if s.startswith("+") else {s} & set(self.models)
        found = set()
        for part in spec.split():
            found |= set.intersection(*(set(one(s)) for s in part.split(",")))
        return [n for n in self.order() if n in found]

    def needed(self, names: Iterable[str]) -> set[str]:
        out, todo = set(), list(names)
        while todo:
            n = todo.pop()
            if n in self.models and n not in out:
                out.add(n)
                todo += self.models[n].inputs
        return out

    def order(self) -> list[str]:
        graph = {m.name: {i for i in m.inputs if i in self.models} for m in self.models.values()}
        return list(TopologicalSorter(graph).static_order())

    def run(self, context: Context, names: Sequence[str] | None = None, full_refresh: bool = False) -> dict[str, DataFrame]:
        """Builds models in order of need. Inputs that aren't models come from ``context.tables``; views stay lazy."""
        out: dict[str, DataFrame] = {}
        for name in self.order():
            if names is not None and name not in names:
                continue
            m = self.models[name]
            inputs = {i: self._input(context, i) for i in m.inputs}
            if m.kind == "view":
                context.tables[name] = out[name] = m.build(context, *inputs.values())
                continue
            t = Table(context.spark, context.path(m.layer, m.alias or name))
            anew = full_refresh and m.full_refresh or not t.exists()
            own = replace(context, target=None if anew else t.read())
            if not anew:
                inputs |= {i: bound.apply(own, inputs[i]) for i, bound in m.reads.items()}
            rows = m.build(own, *inputs.values())
            if m.after and not anew:
                rows = m.after.apply(own, rows)
            if m.kind == "table" or anew:
                t.overwrite(rows)
            elif m.kind == "merge":
                t.merge(rows, m.key, m.update, m.schema_change)
            elif m.kind == "insert":
                t.insert(rows, m.key)
            elif m.kind == "range":
                t.replace_range(rows, m.replaced(own))
            else:
                t.append(rows)
            for h in m.hooks:
                t.keep_referenced(h.keep(own, t.read(), *(self._input(context, i) for i in h.inputs)), m.key)
            context.tables[name] = out[name] = t.read()
        return out

    def _input(self, context: Context, name: str) -> DataFrame:
        if name in context.tables:
            return context.tables[name]
        m = self.models.get(name)
        if m and m.kind != "view":
            return Table(context.spark, context.path(m.layer, m.alias or name)).read()
        if m:
            return m.build(context, *(self._input(context, i) for i in m.inputs))
        raise KeyError(f"no table {name}")


def apply_row_filter(df: DataFrame, column: str, allowed: DataFrame) -> DataFrame:
    """Row-level access: only rows whose column is among the allowed values."""
    return df.join(allowed.select(F.col(allowed.columns[0]).alias(column)).distinct(), column, "left_semi")


#: The registry of the library's own models.
MODELS = Registry()
model = MODELS.model
