"""Oracle SQL per registered query."""

from oracle import assembly, cohort, ingest, models, partner, refine, state, tree, usage

ORACLE: dict[str, str] = {
    "days_to_first_sale": cohort.days_to_first_sale(),
    "days_to_last_sale": cohort.days_to_last_sale(),
    "lifetime_value": cohort.lifetime_value(),
    "lifetime_value_of_tenant": cohort.lifetime_value("AND client = 'europe'"),
    "tenant_report_chain": cohort.tenant_report_chain(),
    "cohort_value": cohort.cohort_value(),
    "cohort_uplift": cohort.cohort_uplift(),
    "first_30_day_sellers": cohort.first_month_sellers(),
    "order_mix_shares": cohort.order_mix(),
    "first_last_by_type": cohort.first_last_by_type(),
    "user_order_metrics": cohort.user_order_metrics(),
    "distributor_orders": cohort.distributor_orders(),
    "latest_version": refine.latest_version(),
    "latest_version_mixed_order": refine.latest_version_mixed_order(),
    "window_closed": refine.window(">="),
    "window_half_open": refine.window(">"),
    "changed_ids": refine.changed_ids(),
    "staging_users": refine.staging_users(),
    "staging_orders_nested": refine.staging_orders(),
    "staging_contacts": refine.staging_contacts(),
    "pii_users": refine.pii_users(),
    "engagement_features": usage.engagement_features(),
    "login_platform_counts": usage.login_platform_counts(),
    "usage_features": usage.usage_features(),
    "own_logins": usage.own_logins(),
    "downline_value": tree.downline_value(),
    "subscription_revenue": tree.subscription_revenue(),
    "product_classes": tree.product_classes(),
    "sponsored_signups": tree.sponsored_signups(),
    "sponsored_orders": tree.sponsored_orders(),
    "generations": tree.generations(),
    "sponsor_edges": tree.sponsor_edges(),
    "direct_sponsor": tree.direct_sponsor(),
    "table_profile": tree.table_profile(),
    "polymorphic_lookup": assembly.polymorphic_lookup(),
    "staging_emails": assembly.staging_emails(),
    "flat_emails": assembly.flat_emails(),
    "staging_links": assembly.staging_links(),
    "site_visitors": assembly.site_visitors(),
    "tasks": assembly.tasks(),
    "staging_sites": assembly.staging_sites(),
    "backfill_users": assembly.backfill_users(),
    "member_types_update": assembly.member_types_update(),
    "backfill_orders": assembly.backfill_orders(),
    "orders_from_users_update": assembly.orders_from_users_update(),
    "order_codes": assembly.order_codes(),
    "backfill_pii": assembly.backfill_pii(),
    "commissions": assembly.commissions(),
    "commissions_nested": assembly.commissions_nested(),
    "order_items_flat": assembly.order_items_flat(),
    "demographics": assembly.demographics(),
    "product_reviews": assembly.product_reviews(),
    "upsert_by_key": assembly.upsert_by_key(),
    "next_window": assembly.next_window(),
    "key_range_read": assembly.key_range_read(),
    "filtered_export_source": assembly.filtered_export_source(),
    "text_key_join": assembly.text_key_join(),
    "rank_fan_out": assembly.rank_fan_out(),
    "encrypt_decrypt_roundtrip": ingest.documents(),
    "file_stream_ingest": ingest.documents(),
    "compress_roundtrip": ingest.compress_roundtrip(),
    "csv_ingest": ingest.csv_ingest(),
    "json_export": ingest.json_export(),
    "export_files": ingest.export_files(),
    "zero_date_scrub": ingest.zero_date_scrub(),
    "temporal_coercion": ingest.temporal_coercion(),
    "replay_upsert": ingest.replay_upsert(),
    "bounded_batches": ingest.bounded_batches(),
    "ingest_rejects": ingest.ingest_rejects(),
    "append_and_reload": ingest.append_and_reload(),
    "window_retry": ingest.window_retry(),
    "tapped_rows": ingest.tapped_rows(),
    "archived_files": ingest.archived_files(),
    "export_nine_tables": partner.export_nine_tables(),
    "tokens": models.tokens(),
    "lemmas": models.lemmas(),
    "phrases": models.phrases(),
    "phrase_tokens": models.phrase_tokens(),
    "trigrams": models.trigrams(),
    "document_terms": models.document_terms(),
    "term_weights": models.term_weights(),
    "topic_facts": models.topic_facts(),
    "rating_errors": models.rating_errors(),
    "recommender_facts": models.recommender_facts(),
    "bucket_upsert": state.bucket_upsert(),
    "users_from_states": state.users_from_states(),
    "contacts_from_states": state.contacts_from_states(),
    "compacted_state": state.compacted_state(),
    "reload_after_crash": state.reload_after_crash(),
    "upline_closure": state.upline_closure(),
    "nested_sets": state.nested_sets(),
    "elapsed_time_pairs": state.elapsed_time_pairs(),
    "logins_before_first_order": state.logins_before_first_order(),
}
