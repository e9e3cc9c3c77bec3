"""Corpus operators: near duplicates, packing, language, mixing, repeats, chat, media, search, URL rules, token counts, phrases, fingerprints, alignment."""

from __future__ import annotations

from findery.llm import alignment, chat, collocations, counts, langid, media, mixing, ngramjoin, packing, passages, simhash, topk, urlrules


def queries():
    return {
        "op1_ngram_jaccard": ngramjoin.op1_ngram_jaccard,
        "op2_packing": packing.op2_packing,
        "op3_language_id": langid.op3_language_id,
        "op4_mixing": mixing.op4_mixing,
        "op5_substring_dedup": passages.op5_substring_dedup,
        "op6_chat_formatting": chat.op6_chat_formatting,
        "op7_media_columns": media.op7_media_columns,
        "op8_exact_topk": topk.op8_exact_topk,
        "op9_url_filters": urlrules.op9_url_filters,
        "op10_token_counts": counts.op10_token_counts,
        "op11_collocations": collocations.op11_collocations,
        "op12_simhash": simhash.op12_simhash,
        "op13_alignment": alignment.op13_alignment,
    }


def oracle_sql():
    return {
        "op1_ngram_jaccard": ngramjoin.ORACLE_SQL,
        "op4_mixing": mixing.ORACLE_SQL,
        "op5_substring_dedup": passages.ORACLE_SQL,
        "op6_chat_formatting": chat.ORACLE_SQL,
        "op8_exact_topk": topk.ORACLE_SQL,
        "op9_url_filters": urlrules.ORACLE_SQL,
        "op11_collocations": collocations.ORACLE_SQL,
    }
