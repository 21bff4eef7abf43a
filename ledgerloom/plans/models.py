"""Model registry: name → (layer, builder, upstream names), with selection.

``ModelSet`` resolves a model by building its upstream first and memoising
each DataFrame, so every model in one run shares the same upstream plan
objects (Spark reuses the identical exchanges inside a query).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import intermediate as I
from ledgerloom.operators import marts as M
from ledgerloom.operators import staging as S


@dataclass(frozen=True)
class Model:
    name: str
    layer: str            # staging | intermediate | marts
    materialized: str     # view | table
    build: Callable[..., DataFrame]
    upstream: tuple[str, ...]
    needs_as_of: bool = False
    passthrough: bool = False   # SELECT * of its single upstream


RAW = ("accounts", "subscriptions", "payments", "support_tickets", "ai_usage_events")

# Relations worth storing when several consumers read them whole: each costs a
# join of large inputs, a parse or a pass over all facts. The joined intermediate
# views are not: each reader computes only the columns it reads, and whoever
# reads a key of theirs needs none of their aggregates. Everything else is a
# per-row projection that Spark fuses into the scan of its stored input.
REUSE_STORE = ("accounts", "payments", "stg_ai_usage_events", "dim_date")

# What a column of a relation reads of the payments; a column not named here
# may read all of them. Keys of the joined views come from their base side alone.
READS_OF_PAYMENTS: dict[str, dict[str, tuple[str, ...]]] = {
    "fact_payments": {"payment_key": ("payment_id",), "payment_id": ("payment_id",), "customer_key": ("account_id",),
                      "subscription_key": ("subscription_id",), "date_key": ("payment_date",)},
    "int_account_revenue": {"account_id": ()},
    "int_customer_360": {"account_id": ()},
    "int_subscription_metrics": {"subscription_id": (), "account_id": ()},
}

# Key columns of views that are, row for row, a column of a relation upstream.
# What is counted of such a column is counted once, where it is stored.
COPIES: dict[str, dict[str, tuple[str, str]]] = {
    "int_account_revenue": {"account_id": ("stg_accounts", "account_id")},
    "int_customer_360": {"account_id": ("stg_accounts", "account_id")},
    "int_subscription_metrics": {"subscription_id": ("stg_subscriptions", "subscription_id"),
                                 "account_id": ("stg_subscriptions", "account_id")},
    "int_ai_usage_metrics": {"event_id": ("stg_ai_usage_events", "event_id")},
    "dim_customer": {"customer_key": ("stg_accounts", "account_id")},
    "dim_subscription": {"subscription_key": ("stg_subscriptions", "subscription_id"),
                         "customer_key": ("stg_subscriptions", "account_id")},
    "fact_ai_usage": {"ai_usage_key": ("stg_ai_usage_events", "event_id"), "customer_key": ("stg_ai_usage_events", "account_id"),
                      "subscription_key": ("stg_ai_usage_events", "subscription_id"),
                      "ai_model_key": ("stg_ai_usage_events", "model_name"), "feature_key": ("stg_ai_usage_events", "feature_name")},
    "fact_payments": {"payment_key": ("stg_payments", "payment_id"), "customer_key": ("stg_payments", "account_id"),
                      "subscription_key": ("stg_payments", "subscription_id")},
    "fact_support_tickets": {"support_ticket_key": ("stg_support_tickets", "ticket_id"),
                             "customer_key": ("stg_support_tickets", "account_id")},
}

# Views that left-join figures onto every row of a relation: their columns in
# COPIES are copies as long as they have as many rows as it.
JOINED_ONTO = {"int_account_revenue": "stg_accounts", "int_customer_360": "stg_accounts", "int_subscription_metrics": "stg_subscriptions"}

MODELS: dict[str, Model] = {m.name: m for m in [
    Model("stg_accounts", "staging", "view", S.stg_accounts, ("accounts",), passthrough=True),
    Model("stg_subscriptions", "staging", "view", S.stg_subscriptions, ("subscriptions",), passthrough=True),
    Model("stg_payments", "staging", "view", S.stg_payments, ("payments",), passthrough=True),
    Model("stg_support_tickets", "staging", "view", S.stg_support_tickets, ("support_tickets",), passthrough=True),
    Model("stg_ai_usage_events", "staging", "view", S.stg_ai_usage_events, ("ai_usage_events",)),
    Model("int_account_revenue", "intermediate", "view", I.int_account_revenue,
          ("stg_accounts", "stg_subscriptions", "stg_payments")),
    Model("int_subscription_metrics", "intermediate", "view", I.int_subscription_metrics,
          ("stg_subscriptions", "stg_payments", "stg_support_tickets"), needs_as_of=True),
    Model("int_customer_360", "intermediate", "view", I.int_customer_360,
          ("stg_accounts", "stg_subscriptions", "stg_payments", "stg_support_tickets")),
    Model("int_ai_usage_metrics", "intermediate", "view", I.int_ai_usage_metrics,
          ("stg_ai_usage_events",)),
    Model("dim_customer", "marts", "table", M.dim_customer, ("stg_accounts",)),
    Model("dim_subscription", "marts", "table", M.dim_subscription, ("stg_subscriptions",)),
    Model("dim_ai_model", "marts", "table", M.dim_ai_model, ("stg_ai_usage_events",)),
    Model("dim_feature", "marts", "table", M.dim_feature, ("stg_ai_usage_events",)),
    Model("fact_ai_usage", "marts", "table", M.fact_ai_usage, ("stg_ai_usage_events",)),
    Model("fact_payments", "marts", "table", M.fact_payments, ("stg_payments",)),
    Model("fact_support_tickets", "marts", "table", M.fact_support_tickets, ("stg_support_tickets",)),
    Model("dim_date", "marts", "table", M.dim_date,
          ("fact_ai_usage", "fact_payments", "fact_support_tickets")),
]}


def downstream(name: str) -> list[str]:
    out, frontier = [], [name]
    while frontier:
        cur = frontier.pop()
        for m in MODELS.values():
            if cur in m.upstream and m.name not in out:
                out.append(m.name)
                frontier.append(m.name)
    return out


def upstream(name: str) -> list[str]:
    out, frontier = [], [name]
    while frontier:
        cur = frontier.pop()
        for u in MODELS[cur].upstream if cur in MODELS else ():
            if u in MODELS and u not in out:
                out.append(u)
                frontier.append(u)
    return out


def select(spec: str | None) -> list[str]:
    """Model selection: ``None`` = all; a layer name; ``m``; ``m+`` (and
    downstream); ``+m`` (and upstream). Space-separated terms are unioned.
    Result is in build (topological) order."""
    if not spec:
        chosen = set(MODELS)
    else:
        chosen = set()
        for term in spec.split():
            if term in ("staging", "intermediate", "marts"):
                chosen |= {n for n, m in MODELS.items() if m.layer == term}
                continue
            up, down = term.startswith("+"), term.endswith("+")
            base = term.strip("+")
            if base not in MODELS:
                raise KeyError(f"unknown model {base!r}")
            chosen.add(base)
            if up:
                chosen |= set(upstream(base))
            if down:
                chosen |= set(downstream(base))
    return [n for n in topological_order() if n in chosen]


def reads_of_payments(columns: set[tuple[str, str]]) -> list[str] | None:
    """The columns of the payments that (model, column) pairs read, the stored
    calendar's dates with them; None: all."""
    read = {"payment_date"}
    for model, column in columns:
        if model in ("payments", "stg_payments"):
            read.add(column)
        elif model in MODELS and "stg_payments" in upstream(model) and model != "dim_date":
            of = READS_OF_PAYMENTS.get(model, {}).get(column)
            if of is None:
                return None
            read.update(of)
    return sorted(read)


def topological_order() -> list[str]:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order or n not in MODELS:
            return
        for u in MODELS[n].upstream:
            visit(u)
        order.append(n)

    for n in MODELS:
        visit(n)
    return order


class ModelSet:
    """Lazily built models over a dict of raw DataFrames."""

    def __init__(self, raw: dict, as_of=None):
        """``raw`` maps raw table names to DataFrames or zero-argument builders."""
        self._frames: dict[str, DataFrame] = {k: v for k, v in raw.items() if isinstance(v, DataFrame)}
        self._builders = {k: v for k, v in raw.items() if not isinstance(v, DataFrame)}
        self.as_of = as_of
        self._given: set[str] = set()       # overridden or stored: read as they are
        self._whole: dict[str, bool] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames and name in self._builders:
            self._frames[name] = self._builders[name]()
        if name not in self._frames:
            m = MODELS[name]
            args = [self[u] for u in m.upstream]
            kw = {"as_of": self.as_of} if m.needs_as_of else {}
            self._frames[name] = m.build(*args, **kw)
        return self._frames[name]

    def override(self, name: str, df: DataFrame) -> None:
        """Replace a built model (e.g. by its materialised table)."""
        self._frames[name] = df
        self._given.add(name)

    def origin(self, model: str, column: str) -> tuple[str, str]:
        """The relation and column that a view's column is a copy of, row for
        row; the column itself if it is none, or if its relation was given."""
        while model in MODELS and model not in self._given:
            if MODELS[model].passthrough:
                model = MODELS[model].upstream[0]
            elif column in COPIES.get(model, {}) and self._row_for_row(model):
                model, column = COPIES[model][column]
            else:
                break
        return model, column

    def _row_for_row(self, model: str) -> bool:
        """Whether a view has a row for each of the relation it joins onto: both
        are counted (Spark leaves a join that adds no rows out of the count)."""
        if model in JOINED_ONTO and model not in self._whole:
            self._whole[model] = self[model].count() == self[JOINED_ONTO[model]].count()
        return self._whole.get(model, True)

    def store(self, spark, names, root: str, only=REUSE_STORE, threads: int = 4, columns: dict[str, list[str]] | None = None) -> None:
        """Write the relations ``names`` depend on that are in ``only``, in
        dependency order, each built from its already-stored upstream, and
        replace them by the stored tables. Each stored relation is computed
        once, and lineage is cut there, so a lost executor never recomputes
        earlier layers. Relations of one dependency level are written as
        concurrent jobs. ``columns`` names the columns of a relation that are
        read, if not all: the others are not stored, and a read of one fails."""
        from ledgerloom.plans.parallel import run_concurrently
        wanted = set()
        for n in names:
            wanted |= {n} | set(upstream(n)) | set(MODELS[n].upstream if n in MODELS else ())
        wanted |= {u for n in list(wanted) if n in MODELS for u in MODELS[n].upstream}
        order = [r for r in RAW if r in wanted] + [n for n in topological_order() if n in wanted]
        todo = [n for n in order if n in only]
        depth: dict[str, int] = {}
        for n in todo:
            ups = set(upstream(n)) | set(MODELS[n].upstream if n in MODELS else ())
            depth[n] = 1 + max([depth[u] for u in ups if u in depth] or [0])
        for d in sorted(set(depth.values())):
            level = [n for n in todo if depth[n] == d]
            for n in level:                               # shared upstream: built once, here
                for u in (MODELS[n].upstream if n in MODELS else ()):
                    self[u]
            paths = {n: f"{root.rstrip('/')}/{n}" for n in level}

            frames = {n: self[n] for n in level}          # plans are built on this thread
            kept = {n: (columns or {}).get(n) or frames[n].columns for n in level}
            run_concurrently({n: (lambda n=n: frames[n].select(*kept[n]).write.mode("overwrite")
                                 .option("compression", "zstd").parquet(paths[n]))
                              for n in level}, threads)
            for n in level:
                self._frames[n] = spark.read.parquet(paths[n])
                self._given.add(n)
                if len(kept[n]) < len(frames[n].columns):
                    self._frames[n] = self._frames[n].select(*[
                        F.col(f.name) if f.name in kept[n] else
                        F.raise_error(F.lit(f"{n}.{f.name} was not stored")).cast(f.dataType).alias(f.name)
                        for f in frames[n].schema.fields])
                # rebuild lazily-derived downstream frames on top of the stored table
                for dn in downstream(n):
                    self._frames.pop(dn, None)
