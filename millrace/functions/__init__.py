from millrace.functions.exprs import (  # noqa: F401
    chi2_sf,
    great_circle_m,
    hash63,
    hash_bucket,
    normal_cdf,
    plain_number,
    round_half_up,
    strip,
)
