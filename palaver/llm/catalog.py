"""Queries of this folder by name, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from palaver.llm import bpe, decontamination, licenses, mixing, pii, quality, resharding, rules, secrets, simhash, tries, warc, whitening


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_rules": rules.op1_quality_rules,
        "op2_decontamination": decontamination.op2_decontamination,
        "op3_simhash": simhash.op3_simhash,
        "op4_quality": quality.op4_quality,
        "op5_mixing": mixing.op5_mixing,
        "op6_warc": warc.op6_warc,
        "op7_pii": pii.op7_pii,
        "op8_secrets": secrets.op8_secrets,
        "op9_bpe": bpe.op9_bpe,
        "op10_resharding": resharding.op10_resharding,
        "op11_whitening": whitening.op11_whitening,
        "op12_licenses": licenses.op12_licenses,
        "op13_prefix_trie": tries.op13_prefix_trie,
    }


def oracles() -> dict[str, str]:
    return {
        "op1_quality_rules": rules.OP1_SQL,
        "op2_decontamination": decontamination.OP2_SQL,
        "op12_licenses": licenses.OP12_SQL,
        "op13_prefix_trie": tries.OP13_SQL,
    }
