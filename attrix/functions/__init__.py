from attrix.functions.columns import (  # noqa: F401
    CONTRACT_MONTHS,
    DEMOGRAPHIC_COLUMNS,
    MISSING_CATEGORY,
    NON_SERVICE_COLUMNS,
    OPTIONAL_SERVICE_COLUMNS,
    YES_NO_COLUMNS,
    avg_price_increase,
    blank_to_null_cast,
    category_to_number,
    coerce_numeric,
    count_equal,
    guarded_ratio_difference,
    impute_constant,
    int_to_bool,
    label_binarise,
    num_optional_services,
    num_optional_services_udf,
    yes_no_to_bool,
)
from attrix.functions.hashing import seeded_hash32, seeded_hash32_sql  # noqa: F401
from attrix.functions.metrics import accuracy, log_loss, positive_probability  # noqa: F401
