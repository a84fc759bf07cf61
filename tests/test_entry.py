import __spark_entry__ as E

# Operator keys of the survey's binding table; each must be registered.
SURVEY_KEYS = """upsert_facts latest_fact fact_history compare_concept concept_coverage tag_fallback
derived_ratio yoy_growth html_to_text token_windows split_sections merge_sections build_chunks
embed_chunks vector_search chunk_metadata upsert_chunks reconcile_snippets reconcile_auto
golden_upsert golden_eval verify_claims normalize_ids parse_filename company_directory
recent_filings facts_from_json load_facts load_report html_tables table_profile
incremental_load""".split()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "l_orderkey" in df.columns


def test_every_key_registered_and_oracles_match_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(SURVEY_KEYS) <= set(E.queries())
