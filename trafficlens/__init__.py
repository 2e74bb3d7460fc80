"""trafficlens: access-log analytics as plain DataFrame functions on Spark."""

from .operators.devices import (  # noqa: F401
    device_counts,
    device_gap,
    device_session_time,
    first_hit_device,
    only_device,
    session_intervals,
    traffic_features,
    user_features,
    with_device,
)
from .operators.load import (  # noqa: F401
    add_lags,
    add_next,
    densify,
    ensure_methods,
    fill_zero,
    label,
    load_features,
    moving_average,
    time_cut,
)
from .operators.models import (  # noqa: F401
    assemble,
    cluster_interval,
    fit_kmeans,
    fit_linear,
    fit_linear_cv,
    fit_tree,
    index_labels,
    kmeans_sweep,
    linear_summary,
    save_model,
    score,
    wssse,
)
from .operators.sessions import (  # noqa: F401
    avg_session_length,
    avg_urls_per_session,
    engaged_users,
    engagement,
    session_length,
    session_spans,
    session_table,
    session_windows,
    sessionize,
    top_users,
    urls_per_session,
)
from .operators.stats import (  # noqa: F401
    corr_matrix,
    corr_with,
    group_mean_sd,
    hash_bucket,
    hash_split,
    regression_metrics,
)
from .sources.logs import (  # noqa: F401
    parse_access_log,
    read_access_log,
    read_lines,
    rejects,
    split_endpoint,
    split_request,
    split_url,
    transform_log,
)
from .sources.tables import cache, materialize, read_table, write_table  # noqa: F401
