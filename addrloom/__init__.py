"""Address variants per property key, as Spark DataFrame jobs."""

from addrloom.plans.abp import abp_flatfile
from addrloom.plans.inspection import (
    flatfile,
    inspect_variants,
    key_variants,
    random_key,
    random_large_key,
    variant_statistics,
)
from addrloom.plans.ngd import ngd_flatfile

__all__ = [
    "abp_flatfile",
    "flatfile",
    "inspect_variants",
    "key_variants",
    "ngd_flatfile",
    "random_key",
    "random_large_key",
    "variant_statistics",
]
