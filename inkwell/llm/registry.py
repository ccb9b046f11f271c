"""The queries of this package for the driver, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from inkwell.llm import ann, decontam, htmlwrap, langid, licenses, mixing, pii, quality, simhash, urlrules


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_license_scan": licenses.op1,
        "op2_quality_cnn": quality.op2,
        "op3_simhash_neardup": simhash.op3,
        "op4_mix_systematic": mixing.op4,
        "op5_pii_boosted": pii.op5,
        "op6_url_rules": urlrules.op6,
        "op7_ann_anisotropic": ann.op7,
        "op8_decontam_prefix_join": decontam.op8,
        "op9_langid_cnn": langid.op9,
        "op10_html_wrappers": htmlwrap.op10,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_license_scan": licenses.op1_sql(), "op4_mix_systematic": mixing.OP4_SQL, "op8_decontam_prefix_join": decontam.OP8_SQL}
