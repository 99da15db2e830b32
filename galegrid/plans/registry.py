"""Names of the registered queries."""

from __future__ import annotations

from . import queries as q
from . import staged as s

QUERIES: dict[str, q.Query] = {
    f.__name__: f
    for f in (
        q.label_counts,
        q.label_counts_aligned,
        q.hourly_align,
        q.hourly_align_utc,
        q.incident_features,
        q.located_label_counts,
        q.incidents_by_hour,
        q.incidents_by_condition,
        q.incidents_by_area_hour,
        q.incidents_by_type,
        q.tree_age,
        q.parse_dates,
        q.named_and_listed,
        q.project_and_rename,
        q.select_variables,
        q.preview_ordered,
        q.rows_per_segment,
        q.left_join_renamed_key,
        q.union_all,
        q.sort_descending,
        q.top_orders,
        q.conditions,
        q.one_hot,
        q.drop_null_rows,
        q.spatial_join,
        q.spatial_mixed_sizes,
        q.spatial_polygons,
        q.spatial_polygons_shuffled,
        q.nearest_incident,
        q.nearest_wkt,
        q.nearest_ties,
        q.wkt_roundtrip,
        q.reproject,
        q.reproject_datum,
        q.area_profile,
        q.area_profile_by_code,
        q.area_profile_long,
        q.pivot_chain,
        q.condition_grid,
        q.label_grid,
        q.located_label_grid,
        q.training_rows,
        q.training_rows_labelled,
        q.training_parts,
        q.table_profile,
        q.date_coverage,
        q.null_counts,
        q.error_metrics,
        q.hash_split,
        q.saturated_model,
        q.saturated_errors,
        q.count_model,
        q.boosted_model,
        q.poisson_trees,
        q.poisson_trees_errors,
        q.model_importances,
        q.exact_split,
        q.fetch_windows,
        q.page_plan,
        q.missing_pages,
        s.weather_text_scan,
        s.weather_mixed_headers,
        s.weather_mixed_folder,
        s.bucketed_align,
        s.weather_json_scan,
        s.incident_csv_scan,
        s.plain_csv_scan,
        s.service_area_scan,
        s.feature_pages,
        s.feature_pages_with_bad_ones,
        s.feature_document,
        s.area_features,
        s.catalog_tables,
        s.written_profile,
    )
}
