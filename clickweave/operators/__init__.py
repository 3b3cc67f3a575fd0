from clickweave.operators.parse import has_key, key_state, key_states, parse_raw, platform_classify, platform_of  # noqa: F401
from clickweave.operators.normalise import (  # noqa: F401
    click_events, events_from_parsed, normalise_events, normalise_with_quarantine, parse_with_reason,
    quarantine_events, quarantine_from_parsed, render_tsv, view_events,
)
from clickweave.operators.click_extract import click_extract, click_extract_ranged, click_extract_sorted  # noqa: F401
from clickweave.operators.app_extract import app_log_extract  # noqa: F401
from clickweave.operators.history import active_user_clicks, active_users, render_history, user_history  # noqa: F401
from clickweave.operators.training import (  # noqa: F401
    doc_labels, doc_stats, negative_pool, qualified_doc_labels, qualified_users, ranked_slots,
    permute_rows, render_train_rows, shuffle_rows, train_rows, user_stats, with_position,
)
from clickweave.operators.ranking import ranged, ranked_in_groups  # noqa: F401
from clickweave.operators.enrich import (  # noqa: F401
    doc_enrich, doc_filter, doc_records, doc_rejects, insert_new, latest_per_key, score_batches, scored_features,
    status_counts, update_matched,
)
