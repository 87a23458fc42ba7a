"""All queries of the core and their DuckDB SQL."""

from docketlake.plans import q_composites, q_filters, q_joins, q_manifests, q_more, q_shape, q_text, q_votes, q_windows

_PARTS = (q_shape, q_filters, q_joins, q_votes, q_windows, q_text, q_manifests, q_more, q_composites)
FLAGSHIP = "agg_metrics"
QUERIES = {name: q for part in _PARTS for name, q in part.R.queries.items()}
SQL = {name: s for part in _PARTS for name, s in part.R.sql.items()}
