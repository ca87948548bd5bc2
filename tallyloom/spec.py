"""Which column plays which part. Operators take a spec; two presets are given."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class TabularSpec:
    """Roles of the columns of a one-row-per-account table."""

    id_col: str
    label_col: str
    positive: str
    int_numeric: tuple[str, ...]
    float_numeric: tuple[str, ...]
    text_numeric: tuple[str, ...]
    flags: tuple[str, ...]
    categorical: tuple[str, ...]
    domains: dict[str, tuple]
    tenure: str
    monthly: str
    total: str
    primary_service: str
    access_service: str
    addons: tuple[str, ...]
    guard_addons: tuple[str, ...]
    raw_bounds: dict[str, tuple[float, float]]
    scoring_bounds: dict[str, tuple[float, float]]

    @property
    def numeric(self) -> tuple[str, ...]:
        return self.int_numeric + self.float_numeric + self.text_numeric + self.flags

    @property
    def features(self) -> tuple[str, ...]:
        return self.numeric + self.categorical

    @property
    def model_numeric(self) -> tuple[str, ...]:
        return self.numeric + DERIVED_NUMERIC

    @property
    def model_categorical(self) -> tuple[str, ...]:
        return self.categorical + DERIVED_CATEGORICAL


# Names of the derived features, tenure bins and their labels.
DERIVED_NUMERIC = ("service_count", "avg_monthly_charges", "no_security_support")
DERIVED_CATEGORICAL = ("tenure_group",)
TENURE_UPPER_BOUNDS = (12, 24, 48)
TENURE_LABELS = ("0-12m", "13-24m", "25-48m", "49m+")

# Category domains of the telecom account table.
_YES_NO = ("Yes", "No")
_NEEDS_INTERNET = ("Yes", "No", "No internet service")
_TELCO_ADDONS = (
    "OnlineSecurity",
    "OnlineBackup",
    "DeviceProtection",
    "TechSupport",
    "StreamingTV",
    "StreamingMovies",
)

TELCO = TabularSpec(
    id_col="customerID",
    label_col="Churn",
    positive="Yes",
    int_numeric=("tenure",),
    float_numeric=("MonthlyCharges",),
    text_numeric=("TotalCharges",),
    flags=("SeniorCitizen",),
    categorical=(
        "gender",
        "Partner",
        "Dependents",
        "PhoneService",
        "MultipleLines",
        "InternetService",
        *_TELCO_ADDONS,
        "Contract",
        "PaperlessBilling",
        "PaymentMethod",
    ),
    domains={
        "gender": ("Male", "Female"),
        "Partner": _YES_NO,
        "Dependents": _YES_NO,
        "PhoneService": _YES_NO,
        "MultipleLines": ("Yes", "No", "No phone service"),
        "InternetService": ("DSL", "Fiber optic", "No"),
        **{addon: _NEEDS_INTERNET for addon in _TELCO_ADDONS},
        "Contract": ("Month-to-month", "One year", "Two year"),
        "PaperlessBilling": _YES_NO,
        "PaymentMethod": (
            "Electronic check",
            "Mailed check",
            "Bank transfer (automatic)",
            "Credit card (automatic)",
        ),
        "Churn": _YES_NO,
    },
    tenure="tenure",
    monthly="MonthlyCharges",
    total="TotalCharges",
    primary_service="PhoneService",
    access_service="InternetService",
    addons=_TELCO_ADDONS,
    guard_addons=("OnlineSecurity", "TechSupport"),
    raw_bounds={"tenure": (0, 72), "MonthlyCharges": (0, 130)},
    scoring_bounds={
        "tenure": (0, 120),
        "MonthlyCharges": (0, 1000),
        "TotalCharges": (0, 200_000),
    },
)

# The look-alike built from orders and line items; see plans/snapshot.py.
_PART_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
_BOUGHT = tuple(f"bought_{name.lower()}" for name in _PART_TYPES)

ACCOUNT = TabularSpec(
    id_col="account_id",
    label_col="churn",
    positive="Yes",
    int_numeric=("tenure",),
    float_numeric=("monthly_charges",),
    text_numeric=("total_charges",),
    flags=("urgent_flag",),
    categorical=("sign_flag", "active", "last_status", *_BOUGHT, "segment", "last_priority"),
    domains={
        "sign_flag": ("Neg", "Pos"),
        "active": _YES_NO,
        "last_status": ("F", "O", "P", "No"),
        **{name: _YES_NO for name in _BOUGHT},
        "segment": ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"),
        "last_priority": (
            "1-URGENT",
            "2-HIGH",
            "3-MEDIUM",
            "4-NOT SPECIFIED",
            "5-LOW",
            "none",
        ),
        "churn": _YES_NO,
    },
    tenure="tenure",
    monthly="monthly_charges",
    total="total_charges",
    primary_service="active",
    access_service="last_status",
    addons=_BOUGHT,
    guard_addons=(_BOUGHT[0], _BOUGHT[3]),
    raw_bounds={"tenure": (0, 72), "monthly_charges": (0, 1_000_000)},
    scoring_bounds={
        "tenure": (0, 120),
        "monthly_charges": (0, 10_000_000),
        "total_charges": (0, 1_000_000_000),
    },
)
PART_TYPES = _PART_TYPES
