"""Two-level product taxonomy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.functions import fixed_values as fixed
from tillmark.functions.staged import Steps, staged
from tillmark.functions.text import quoted, strip_plain, title_case

_CORRUPT = r"""^\p{Nd}|["'\[\]/]"""


def category_steps(main: Column, sub: Column | None = None, prefix: str = "canonical") -> Steps:
    """``<prefix>_l1`` and ``<prefix>_l2``: of the sub-category if known, else of the main
    one, else the main text's own title for both.

    A text that starts with a digit or holds quotes, brackets or slashes is debris of
    another field and counts as ``Other``.
    """
    plain, pair = F.col(f"_{prefix}_main"), F.col(f"_{prefix}_pair")
    texts = {f"_{prefix}_main": strip_plain(main)} | ({} if sub is None else {f"_{prefix}_sub": strip_plain(sub)})
    tried = [f"_{prefix}_main"] if sub is None else [f"_{prefix}_sub", f"_{prefix}_main"]
    known = [found for name in tried for found in _lookups(F.lower(F.col(name)))]
    title = F.when((plain != "") & ~plain.rlike(_CORRUPT), title_case(plain)).otherwise(fixed.OTHER_CATEGORY)
    own = F.struct(title.alias("l1"), F.lit(None).cast("string").alias("l2"))
    return [
        texts,
        {f"_{prefix}_pair": F.coalesce(*known, own)},
        {f"{prefix}_l1": pair["l1"], f"{prefix}_l2": F.coalesce(pair["l2"], pair["l1"])},
    ]


def with_category(df: DataFrame, main: Column, sub: Column | None = None, prefix: str = "canonical") -> DataFrame:
    added = staged(df, category_steps(main, sub, prefix))
    return added.select(*[F.col(f"`{name}`") for name in df.columns], f"{prefix}_l1", f"{prefix}_l2")


def _lookups(key: Column) -> list[Column]:
    rows = [(quoted(token), quoted(l1), quoted(l2)) for token, l1, l2 in fixed.TAXONOMY]
    table = F.expr(f"map({', '.join(f'{token}, named_struct("l1", {l1}, "l2", {l2})' for token, l1, l2 in rows)})")
    return [F.try_element_at(table, key), F.try_element_at(table, F.regexp_replace(key, r"\s+", "-"))]
