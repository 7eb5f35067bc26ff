"""Ready contracts for the three lead tables.

Their keys use the ``compat`` encoding over cleaned values, with raw extras hashed.
They equal keys made elsewhere only where the cleaning came to the same values, and
values later than the load are hashed before they are settled.
"""

from __future__ import annotations

from ..functions.names import key_name
from . import Contract

# Column names, types and roles of the three tables.

LEAD = """
    LEAD_GUID string, LEGACY_LEAD_ID string, INDIV_ID string, HH_ID string,
    ADDR_ID string, LEAD_CODE string, LEAD_TYPE_ID decimal(38,0),
    LEAD_TYPE string, LEAD_SOURCE string, LEAD_CREATE_DATE timestamp,
    FIRST_NAME string, MIDDLE_NAME string, LAST_NAME string, SUFFIX string,
    BIRTH_DATE string, AGE decimal(38,0), SEX string, STREET_1 string,
    STREET_2 string, CITY string, STATE_ID decimal(38,0), STATE string,
    ZIP string, ZIP5 string, COUNTY string, COUNTRY string, PHONE string,
    HOME_PHONE string, CELL_PHONE string, WORK_PHONE string,
    DO_NOT_CALL string, CALLER_ID string, EMAIL string, DYNAMIC_LEAD string,
    PROSPECT_ID string, EXT_PARTNER_ID string, CHANNEL_ID decimal(38,0),
    CHANNEL string, OPT_SOURCE_ID string, SOURCE_ID decimal(38,0),
    SUB_SOURCE_ID boolean, SOURCE_OF_REFERRAL string, DIVISION string,
    LEAD_SUB_SOURCE string, LEAD_SUB_SOURCE_ID string, LENDER string,
    LOAN_AMOUNT string, LOAN_DATE date, DIABETES string,
    HEALTH_PROBLEMS string, HEART_PROBLEMS string, HEIGHT string,
    HIGH_BP_CHOL string, IS_INSURED string, SMOKER string, OCCUPATION string,
    SPOUSE string, COBORROWER_AGE double, COBORROWER_BIRTH_DATE timestamp,
    COBORROWER_HEIGHT string, COBORROWER_ON_MORTGAGE string,
    COBORROWER_NAME string, COBORROWER_RELATION string, COBORROWER_SEX string,
    COBORROWER_SMOKER string, COBORROWER_WEIGHT string,
    COBORROWER_OCCUPATION string, DATA_SOURCE string, LEAD_ORIGIN_URL string,
    MAILING_ID string, SUSPECT_CAMPAIGN_ID decimal(38,0),
    CONSUMER_DEBT double, MORTGAGE_DEBT string, UTM_CAMPAIGN string,
    UTM_MEDIUM string, UTM_SOURCE string, REFERRING_URL string,
    PCS_POLICIES_ID decimal(38,0), CREATE_DATE timestamp,
    MODIFY_DATE timestamp, SOURCE_TABLE string, IS_DELETED_SOURCE string,
    EXP_DATE timestamp, SOURCE_TYPE string, SOURCE_TYPE_ID decimal(38,0),
    PRODUCT_TYPE string, LEAD_ATTRIBUTES string,
    CUSTODY_TARGET_AUDIENCE string, SOURCE string,
    PRODUCT_TYPE_ID decimal(38,0), LEAD_SOURCE_ID string,
    ORIGIN_SYSTEM_ID string, ORIGIN_SYSTEM string, ORIGIN_SYSTEM_ORIG string,
    LEAD_INGESTION_METHOD string
"""

LEAD_XREF = """
    LEAD_XREF_GUID string, LEGACY_LEAD_ID string, LEAD_CODE string,
    LEAD_LEVEL_ID string, LEAD_LEVEL string, DATA_SOURCE_ID string,
    LEVEL_DATE timestamp, CREATE_DATE timestamp, MODIFY_DATE timestamp,
    AVAILABLE_FOR_PURCHASE_IND string, IS_DELETED_SOURCE string,
    LEAD_LEVEL_ALIAS string
"""

LEAD_ASSIGNMENT = """
    LEAD_ASSIGNMENT_GUID string, LEAD_XREF_GUID string, AGENT_CODE string,
    PURCHASE_DATE timestamp, PURCHASE_PRICE double, ASSIGN_DATE timestamp,
    INACTIVE_IND string, STATUS string, AGENT_EXTUID string,
    ALLOCATE_IND string, COMMENTS string, SFG_DIRECT_AGENT_ID string,
    BASE_SHOP_OWNER_AGENT_ID string, TOTAL_UPLINE_AGENT_CODES string,
    UNPAID_IND string, APP_COUNT string, APP_APV string,
    ACTUAL_APP_COUNT string, ACTUAL_APV string, CREATE_DATE timestamp,
    MODIFY_DATE timestamp, SOURCE_TABLE string, METADATA string,
    STATUS_DATE timestamp, IS_DELETED_SOURCE boolean, ORDER_NUMBER string,
    LEAD_STATUS_ID string, LEAD_STATUS string, HQ_PURCHASE_AMOUNT double,
    LEAD_ORDER_SYSTEM_ID string, LEAD_ORDER_SYSTEM string,
    ORDER_SYSTEM_ID string, ORDER_SYSTEM string, ORDER_SYSTEM_ORIG string,
    EXCLUSIVITY_END_DATE timestamp
"""

LEAD_RENAMES = {"originsystem_orig": "ORIGIN_SYSTEM_ORIG"}
LEAD_JSON = ("LEAD_ATTRIBUTES",)
LEAD_ASSIGNMENT_JSON = ("METADATA",)
FLAGS = ("IS_DELETED_SOURCE",)
LEAD_ASSIGNMENT_CLAMPED = (
    "PURCHASE_DATE",
    "ASSIGN_DATE",
    "CREATE_DATE",
    "MODIFY_DATE",
    "STATUS_DATE",
    "EXCLUSIVITY_END_DATE",
)


def lead_contracts(system: str, **options) -> dict[str, Contract]:
    """The three contracts; ``system`` is the source's code in key names.

    ``options`` go to every contract, as ``timestamp_formats`` or
    ``free_form_zone``.
    """
    shapes = {
        "lead": dict(columns=LEAD, renames=LEAD_RENAMES, json=LEAD_JSON, flags=FLAGS),
        "lead_xref": dict(columns=LEAD_XREF, flags=FLAGS),
        "lead_assignment": dict(
            columns=LEAD_ASSIGNMENT,
            json=LEAD_ASSIGNMENT_JSON,
            future=dict.fromkeys(LEAD_ASSIGNMENT_CLAMPED, "clamp"),
        ),
    }
    return {
        name: Contract(
            **{
                "name": name,
                "key": key_name(system, name),
                "extras": "hash",
                "key_encoding": "compat",
                **shape,
                **options,
            }
        )
        for name, shape in shapes.items()
    }
