"""Sampling before affinity (SM1, SM2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.operators.topk import tree_top

DEFAULT_FRACTION = 0.1
DEFAULT_SEED = 42


def row_sample(df: DataFrame, fraction: float = DEFAULT_FRACTION, seed: int = DEFAULT_SEED) -> DataFrame:
    """Bernoulli sample of rows (the reference's default). It thins baskets,
    so pair counts fall with the square of the rate (SURVEY T7)."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def session_threshold(fraction: float) -> str:
    """Hex prefix bound: keep a session when md5's first 8 hex digits are below it."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be in [0, 1]")
    return format(min(int(fraction * 16**8), 16**8 - 1), "08x") if fraction < 1 else "g"


def session_sample(
    df: DataFrame, fraction: float = DEFAULT_FRACTION, session: str = "user_session"
) -> DataFrame:
    """Keep whole sessions: a deterministic hash test on the session key.

    Same sessions on every run and every engine (md5 is standard), so baskets
    stay intact and lift stays unbiased. A null session hashes as ``""``.
    """
    key = F.md5(F.coalesce(F.col(session).cast("string"), F.lit("")))
    return df.filter(F.substring(key, 1, 8) < F.lit(session_threshold(fraction)))


def sample_order(key: str, seed: int = DEFAULT_SEED) -> list[Column]:
    """A random but fixed order of rows: md5 of the seed and the key, then the key."""
    return [F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))), F.col(key)]


def bottom_k(df: DataFrame, n: int, key: str = "event_id", seed: int = DEFAULT_SEED) -> DataFrame:
    """Exactly ``n`` rows (all, if there are fewer), those whose keys hash least.

    The same rows for any partitioning, run or engine, unlike a Bernoulli
    sample. Samples merge: the bottom-k of several days' bottom-k is that of all
    their rows.
    """
    if n < 1:
        raise ValueError("n must be positive")
    return tree_top(df, sample_order(key, seed), n)
