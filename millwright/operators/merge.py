"""Upserts as one full outer join that returns the new table state."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwright.functions import clock
from millwright.functions.clock import AsOf
from millwright.functions.values import any_differs
from millwright.operators.dedup import first_per_key

ACTION = "_acao"
Rule = Callable[[Callable[[str], Column]], Column]


def unique_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows; the job fails when a key occurs twice.

    The check rides on the key partitioning and sort the merge join needs anyway, and
    stops at the first repeated row instead of counting whole groups.
    """
    w = Window.partitionBy(*keys).orderBy(*keys)
    text = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    check = F.assert_true(F.col("_n") == 1, F.concat(F.lit(f"duplicate merge key ({', '.join(keys)}): "), text))
    return source.withColumn("_n", F.row_number().over(w)).where(check.isNull()).drop("_n")


def merge_into(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    as_of: AsOf,
    *,
    update: str = "changed",
    compare: Sequence[str] | None = None,
    refresh_when: Rule | None = None,
    missing: str = "keep",
    missing_where: Rule | None = None,
    on_insert: Mapping[str, Column] | None = None,
    on_update: Mapping[str, Column] | None = None,
    on_missing: Mapping[str, Column] | None = None,
    audit: str | None = "data_atualizacao_db",
    with_action: bool = False,
) -> DataFrame:
    """New state of ``target`` after merging ``source``; same columns, same types.

    - ``update``: ``"changed"`` updates a matched row when a ``compare`` column (default: every
      shared non-key column) ``IS DISTINCT FROM`` the source or ``refresh_when`` holds for
      the target row; ``"always"`` updates every matched row.
    - ``missing``: what happens to target rows without a source row for which
      ``missing_where`` holds: ``"keep"``, ``"delete"`` or ``"update"`` (soft delete through
      ``on_missing``).
    - ``on_insert`` / ``on_update`` / ``on_missing``: values of columns the source lacks.
    - ``audit`` gets ``as_of`` in every row that was written and is never compared.
    - ``with_action`` adds the action (``insert``, ``update``, ``missing``, ``delete``, NULL for
      untouched) and then also returns deleted rows.

    Source keys must be unique (see :func:`unique_keys`); source rows with a NULL key never match,
    need not be unique and are all inserted.
    """
    if update not in ("changed", "always") or missing not in ("keep", "delete", "update"):
        raise ValueError(f"unknown merge mode update={update!r} missing={missing!r}")
    keys = list(keys)
    types = dict(target.dtypes)
    shared = [c for c in target.columns if c in source.columns and c not in keys and c != audit]
    compared = list(compare) if compare is not None else shared

    # Cast before the key check, so the join can reuse its partitioning and order.
    rows = source.select(
        *[F.col(k).cast(types[k]).alias(k) for k in keys],
        *[F.col(c).cast(types[c]).alias(f"_s_{c}") for c in shared],
    )
    keyless = reduce(or_, [F.col(k).isNull() for k in keys])
    s = unique_keys(
        rows.where(~keyless),
        keys,
    ).withColumn("_in_source", F.lit(True))
    t = target.withColumn("_in_target", F.lit(True))
    # Rows with a NULL key match nothing: they go past the join, where they would meet in one task.
    both = t.join(s, keys, "full_outer").unionByName(
        rows.where(keyless).withColumn("_in_source", F.lit(True)), allowMissingColumns=True
    )

    in_s, in_t = F.col("_in_source").isNotNull(), F.col("_in_target").isNotNull()
    changed = F.lit(True)
    if update == "changed":
        changed = any_differs((F.col(c), F.col(f"_s_{c}")) for c in compared)
        if refresh_when is not None:
            changed = changed | F.coalesce(refresh_when(F.col), F.lit(False))
    gone = F.lit(missing != "keep")
    if missing_where is not None:
        gone = gone & F.coalesce(missing_where(F.col), F.lit(False))
    word = "delete" if missing == "delete" else "missing"
    action = (
        F.when(~in_t, "insert").when(in_s & in_t & changed, "update").when(~in_s & gone, word)
    )
    both = both.withColumn(ACTION, action)

    a = F.col(ACTION)
    inserted, updated, touched = a == "insert", a == "update", a == "missing"

    def value(c: str) -> Column:
        if c in keys:
            return F.col(c)
        if c == audit:
            return F.when(inserted | updated | touched, clock.ntz(as_of).cast(types[c])).otherwise(F.col(c))
        out = F.when(touched, on_missing[c].cast(types[c])) if c in (on_missing or {}) else None
        if c in shared:
            branch = (inserted | updated, F.col(f"_s_{c}"))
            out = F.when(*branch) if out is None else out.when(*branch)
        else:
            for cond, given in ((inserted, on_insert), (updated, on_update)):
                if c in (given or {}):
                    branch = (cond, given[c].cast(types[c]))
                    out = F.when(*branch) if out is None else out.when(*branch)
        return F.col(c) if out is None else out.otherwise(F.col(c))

    columns = [value(c).alias(c) for c in target.columns]
    if with_action:
        return both.select(*columns, ACTION)
    return both.where(F.coalesce(a != "delete", F.lit(True))).select(*columns)


def soft_delete_merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    as_of: AsOf,
    active: str = "ativo",
    deactivated_at: str | None = None,
    **kwargs,
) -> DataFrame:
    """Dimension upsert: present rows are active, absent ones are switched off.

    With ``deactivated_at`` the first disappearance is stamped and only rows without a
    stamp are touched; coming back clears flag and stamp.
    """
    now = clock.ntz(as_of)
    on, off = {active: F.lit(True)}, {active: F.lit(False)}
    back = dict(on)
    where = None
    if deactivated_at is not None:
        off[deactivated_at] = F.coalesce(F.col(deactivated_at), now)
        back[deactivated_at] = F.lit(None)

        def where(col):
            return col(deactivated_at).isNull()

    return merge_into(
        target, source, keys, as_of, update="always", missing="update", missing_where=where,
        on_insert=on, on_update=back, on_missing=off, **kwargs,
    )


def replace_window(
    target: DataFrame,
    source: DataFrame,
    in_window: Column,
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """Delete the window from the target, then insert the source.

    With ``keys`` a source row whose key is still present (or repeated) is ignored.
    """
    kept = target.where(~F.coalesce(in_window, F.lit(False)))
    new = source
    if keys is not None:
        new = first_per_key(new, keys, [F.col(k).asc() for k in keys]).join(
            kept.select(*keys), list(keys), "left_anti"
        )
    return kept.unionByName(new, allowMissingColumns=True).select(*target.columns)


def append_history(current: DataFrame, history: DataFrame, is_current: Column) -> DataFrame:
    """Current rows plus the history of every other period."""
    return current.unionByName(
        history.where(~F.coalesce(is_current, F.lit(False))), allowMissingColumns=True
    )
