"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillwise.llm import bag_minhash, byte_cnn, fertility, fm_index, hash_tree, importance, k2_treap, packing, quotations
from tillwise.llm import recompression, toxicity, url_filter, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quotations": quotations.query,
        "op2_recompression": recompression.query,
        "op3_bag_minhash": bag_minhash.query,
        "op4_url_logistic": url_filter.query,
        "op5_ftrl": toxicity.query,
        "op6_packing": packing.query,
        "op7_fertility": fertility.query,
        "op8_fm_index": fm_index.query,
        "op9_hash_tree": hash_tree.query,
        "op10_byte_cnn": byte_cnn.query,
        "op11_importance": importance.query,
        "op12_warc": warc.query,
        "op13_k2_treap": k2_treap.query,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_quotations": quotations.oracle(),
        "op9_hash_tree": hash_tree.oracle(),
        "op11_importance": importance.oracle(),
        "op12_warc": warc.oracle(),
        "op13_k2_treap": k2_treap.oracle(),
    }
