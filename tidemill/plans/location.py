"""The location-event roll-up: its columns, filters and job."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.clean import hash64, hashed_user_id, ipv4_to_long, mac_to_long
from tidemill.operators import predicates
from tidemill.operators.rollup import Output, reduced_rollup, rollup
from tidemill.operators.schema import conform
from tidemill.sources.delimited import RawField

# Event type of a bid request and the two "missing" markers.
BID_REQUEST = 102
MISSING_CODE = -9999
MISSING_MAC = -1

KEYS = [
    "userId", "sourceIp", "latitude", "longitude", "publisherTypeId",
    "packageId", "productId", "bssid", "networkTypeId",
]
REDUCED_KEYS = [
    "userId", "sourceIp", "publisherTypeId", "packageId", "productId", "networkTypeId",
]

INT, TEXT, TIME, DAY, PLACE = "bigint", "string", "timestamp", "date", "decimal(13,8)"

# The columns of the target in load order, as (name, type). The
# numbered groups are repeated by `_numbered`.
_HEAD = [
    ("ts", TIME), ("sessionId", INT), ("osId", INT), ("advertisingId", TEXT), ("sourceIp", INT),
    ("country", TEXT), ("ispId", INT), ("publisherId", INT), ("productId", INT), ("eDate", DAY),
    ("cityId", INT), ("localTs", TIME), ("localTZoneId", INT), ("locationSourceId", INT),
    ("longitude", PLACE), ("latitude", PLACE), ("locationAccuracy", INT), ("locationTs", TIME),
    ("ispNameId", INT), ("networkTypeId", INT), ("simMCC", INT), ("simMNC", INT),
    ("cellMCC", INT), ("cellMNC", INT), ("cellLAC", INT), ("cellId", INT),
    ("cellSignalLevel", INT), ("ssid", TEXT), ("bssid", INT), ("signalLevel", INT),
]
_WIFI = [("ssid", TEXT), ("bssid", INT), ("signalLevel", INT), ("scanTs", TIME)]
_MIDDLE = [
    ("userAgent", TEXT), ("sdkTypeId", INT), ("sourceModuleId", INT), ("sourceServerId", INT),
    ("isCoppaApp", INT), ("locationContextId", INT), ("regionId", INT), ("publisherTypeId", INT),
]
_CELL = [
    ("mRegistered", INT), ("cellMcc", INT), ("cellMnc", INT), ("cellLac", INT), ("cellId", INT),
    ("cellUnit", INT), ("cellBlon", PLACE), ("cellBlat", PLACE), ("cellRadio", TEXT),
    ("cellTs", TIME), ("cellSignalLevel", INT),
]
_FIX = [
    ("locationSourceId", INT), ("longitude", PLACE), ("latitude", PLACE),
    ("locationAccuracy", INT), ("locationTs", TIME),
]
_ENRICHED = [
    ("enrichedLatitude", PLACE), ("enrichedLongitude", PLACE), ("enrichedAccuracy", INT),
    ("enrichedLocationTs", TIME), ("userId", INT), ("rawIspId", INT), ("rawIspNameId", INT),
    ("eventTypeId", INT), ("wifiRssiLevel", INT), ("cellIspNameId", INT), ("isRoaming", INT),
    ("isForeground", INT),
]
_TAIL = [
    ("sdkVersionId", INT), ("loadTs", TIME), ("consumerId", INT), ("rawClientTS", INT),
    ("packageId", INT), ("pas", INT), ("limitAdTracking", TEXT), ("isValidAdvertisingId", INT),
    ("isValidGps", INT), ("isValidBssidInt", INT), ("rtbCarrierNameId", INT),
    ("rtbCarrierMcc", INT), ("rtbCarrierMnc", INT), ("biRunId", INT),
    ("advertisingIdSourceId", TEXT), ("channelId", INT), ("gdpr", TEXT), ("permissions", TEXT),
    ("isLocationEnabled", INT), ("deviceManufacturerId", INT), ("deviceModelId", INT),
    ("deviceTypeId", INT), ("deviceVersionId", INT), ("genderId", INT), ("age", INT),
    ("inputLangsId", INT), ("geoTypeId", INT), ("usPrivacyId", TEXT), ("localeId", INT),
    ("trafficTypeId", INT), ("sioIdTypeId", INT), ("siteDomainId", INT), ("sitePageId", INT),
    ("siteNameId", INT), ("numBidRequests", INT), ("numEvents", INT), ("appNameId", INT),
]


def _numbered(group: list[tuple[str, str]], count: int) -> list[tuple[str, str]]:
    return [(f"{name}{i}", kind) for i in range(1, count + 1) for name, kind in group]


OUTPUT_TYPES: list[tuple[str, str]] = (
    _HEAD + _numbered(_WIFI, 5) + _MIDDLE + _numbered(_CELL, 5) + _numbered(_FIX, 3)
    + _ENRICHED + _numbered([("wifiRssiLevel", INT)], 5) + _TAIL
)
COMPUTED = {"loadTs", "biRunId", "numBidRequests", "numEvents"}
INPUT_TYPES = [(n, t) for n, t in OUTPUT_TYPES if n not in COMPUTED] + [("loadTs", TIME)]

_MINIMUM = {"osId", "locationAccuracy", "cellSignalLevel", "signalLevel"} | {
    f"{name}{i}" for name in ("signalLevel", "cellSignalLevel") for i in range(1, 6)
}
_CODE_SENTINEL = {"simMCC", "simMNC", "cellMCC", "cellMNC"}
_MAC_SENTINEL = {"bssid"} | {f"bssid{i}" for i in range(1, 6)}


# Columns and types of the tab separated event export, in file order.
EXPORT_SCHEMA = """
    ts timestamp, sessionId string, osId int, advertisingId string, sourceIp string, country string,
    ispId bigint, publisherId bigint, eDate date, cityId int, localTs timestamp, localTZoneId double,
    longitude double, latitude double, locationAccuracy int, locationSourceId int, locationTs string,
    userAgent string, sdkTypeId int, sourceModuleId bigint, sourceServerId int, isCoppaApp int,
    locationContextId int, advertisingId2 string, eventTypeId int, publisherTypeId bigint, regionId int,
    mRegistered1 int, cellMcc1 int, cellMnc1 int, cellLac1 int, packageId int, simMCC int, simMNC string,
    cellMCC int, cellId1 bigint, cellSignalLevel1 int, ssid string, cellLAC int, locationAccuracy1 double,
    ssid1 string, userId bigint, ispNameId bigint, networkTypeId int, isValidAdvertisingId int,
    bssid bigint, ssid2 string, wifiRssiLevel int, wifiRssiLevel1 int, ssid3 string, ssid4 string,
    consumerId bigint, ssid5 string, sdkVersionId int, age int, deviceManufacturerId int, genderId int,
    deviceModelId int, appNameId bigint, deviceTypeId bigint, deviceVersionId bigint, channelId bigint,
    isLocationEnabled int, permissions string, gdpr string, usPrivacyId string, isValidGps int,
    limitAdTracking string, pas int, cellId int, advertisingIdSourceId string, rawClientTS bigint,
    bssid1 string, bssid2 string, bssid3 string, isValidBssidInt int, bssid4 string, bssid5 int"""

# Column names of the newer export, by position.
POSITIONAL_NAMES = (
    "ts sessionId osId advertisingId sourceIp country publisherId productId eDate cityId localTs"
    " longitude latitude ispNameId networkTypeId simMCC simMNC userAgent sourceModuleId"
    " sourceServerId isCoppaApp regionId publisherTypeId userId eventTypeId consumerId packageId"
    " limitAdTracking isValidAdvertisingId isValidGps isValidBssidInt rtbCarrierNameId rtbCarrierMcc"
    " rtbCarrierMnc pas channelId processingRequestStatus isQpsSkipped deviceVersionId bidFloor"
    " requestId deviceManufacturerId deviceModelId deviceTypeId gdpr appNameId publisherNameId width"
    " height genderId age languageId inputLangsId geoTypeId advertisingIdSourceId placementId"
    " videoSupportModeId nodes firstNodeId releaseVersionId usPrivacyId dataCenterId sChainComplete"
    " displayManagerNameId displayManagerVersionId omidProviderNameId omidProviderVersionId"
    " subPublisherManagementTypeId isVisibility localeId locationTs adTagId sitePageId siteNameId"
    " siteDomainId trafficTypeId sioIdTypeId isUserId"
).split()

# The last fields of a bulk-load line, after the numbered levels.
_BULK_TAIL = (
    "sdkVersionId loadTs consumerId rawClientTS packageId limitAdTracking isValidAdvertisingId"
    " isValidGps isValidBssidInt rtbCarrierNameId rtbCarrierMcc rtbCarrierMnc pas permissions"
    " isLocationEnabled deviceVersionId releaseVersionId advertisingIdSourceId deviceModelId"
    " deviceManufacturerId localeId inputLangsId"
).split()


def bulk_fields() -> list[RawField]:
    """Fields of a bulk-load line in file order, with what is computed from them.

    Session and user id are hashed, the address and the access points become
    numbers. The line's own load time is ignored: the load sets it.
    """
    types = dict(OUTPUT_TYPES) | {"releaseVersionId": INT}
    head = [n for n, _ in _HEAD]
    head.insert(2, "sdkTypeId")
    middle = [n for n, _ in _MIDDLE if n != "sdkTypeId"]
    numbered = _numbered(_CELL, 5) + _numbered(_FIX, 3) + _ENRICHED
    numbered += _numbered([("wifiRssiLevel", INT)], 5)
    order = head + [n for n, _ in _numbered(_WIFI, 5)] + middle + [n for n, _ in numbered] + _BULK_TAIL
    computed = {"sessionId": hash64, "userId": hash64, "sourceIp": ipv4_to_long}
    computed |= {n: mac_to_long for n in _MAC_SENTINEL}
    fields = []
    for name in order:
        if name == "loadTs":
            fields.append(RawField("_line_load_ts"))
        else:
            fields.append(RawField(name, types[name], computed.get(name)))
    return fields


def staged(rows: DataFrame) -> DataFrame:
    """Rows of any export as staged events: declared types, absent columns NULL.

    Numbers that an export holds as text are cast here, so that their maximum is
    numeric; text that is no number becomes NULL.
    """
    types = {f.name.lower(): f.dataType for f in input_schema().fields}
    text = {
        f.name: F.col(f"`{f.name}`").try_cast(types[f.name.lower()])
        for f in rows.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name.lower() in types
    }
    return conform(rows.withColumns(text), input_schema())


def input_schema() -> T.StructType:
    """Declared schema of the staged events."""
    return T.StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in INPUT_TYPES))


def target_schema() -> T.StructType:
    """Declared schema of the rolled-up table."""
    return T.StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in OUTPUT_TYPES))


def outputs(run_id: int) -> list[Output]:
    """The 182 output columns in load order."""
    special = {
        "loadTs": Output("loadTs", "value", value=F.current_timestamp()),
        "biRunId": Output("biRunId", "value", value=F.lit(run_id).cast("bigint")),
        "numBidRequests": Output("numBidRequests", "count_equal", "eventTypeId", value=BID_REQUEST),
        "numEvents": Output("numEvents", "count"),
    }
    result = []
    for name, _ in OUTPUT_TYPES:
        sentinel = (
            MISSING_CODE if name in _CODE_SENTINEL else MISSING_MAC if name in _MAC_SENTINEL else None
        )
        if name in special:
            result.append(special[name])
        elif name in KEYS:
            result.append(Output(name, "key", sentinel=sentinel))
        else:
            result.append(Output(name, "min" if name in _MINIMUM else "max", sentinel=sentinel))
    return result


def select_events(
    events: DataFrame,
    load_from: datetime,
    load_to: datetime,
    publisher_types: list[int],
    countries: list[str] | None = None,
    excluded_users: DataFrame | None = None,
    max_days_back: int = 30,
) -> DataFrame:
    """Valid events of the load window, without users on the exclusion list."""
    rows = events.filter(
        predicates.load_window(events, "loadTs", load_from, load_to)
        & predicates.date_floor(events, "eDate", load_from, max_days_back)
        & predicates.one_of("publisherTypeId", publisher_types)
        & predicates.is_valid("isValidAdvertisingId")
        & predicates.one_of("country", countries)
    )
    if excluded_users is None:
        return rows
    return predicates.exclude_listed(rows, "userId", excluded_users, "userId")


def roll_up(events: DataFrame, run_id: int) -> DataFrame:
    """Full minute roll-up of selected events: one exchange, 182 columns."""
    return rollup(events, outputs(run_id), KEYS)


def write_by_day(rolled: DataFrame, path: str) -> None:
    """Write rolled-up rows partitioned by event date, in files of even size."""
    day = rolled.hint("rebalance", "eDate")
    day.write.mode("overwrite").partitionBy("eDate").parquet(path)


def clean_identity(events: DataFrame, digits: int = 8) -> DataFrame:
    """User number from the advertising id and the address as a number."""
    return events.withColumns(
        {
            "userId": hashed_user_id(F.col("advertisingId"), digits),
            "sourceIp": ipv4_to_long(F.col("sourceIp")),
        }
    )


# Aggregated columns of the reduced roll-up (the position is not a
# key there), its empty target columns, and the columns of a core export.
REDUCED_OUTPUTS = [
    "ts", "sessionId", "osId", "advertisingId", "country", "publisherId", "eDate", "cityId",
    "localTs", "ispNameId", "userAgent", "sourceModuleId", "sourceServerId", "isCoppaApp",
    "regionId", "eventTypeId", "consumerId", "isValidAdvertisingId", "latitude", "longitude",
]
REDUCED_PLACEHOLDERS = [
    "ispId", "localTZoneId", "locationSourceId", "locationAccuracy", "locationTs", "simMCC",
    "simMNC", "cellMCC", "cellMNC", "cellLAC", "cellId", "cellSignalLevel", "ssid", "bssid",
    "signalLevel", "limitAdTracking", "isValidGps", "pas", "channelId",
]
CORE_COLUMNS = [
    "userId", "time_slice_minute", "sourceIp", "publisherTypeId", "packageId", "productId",
    "networkTypeId", "ts", "sessionId", "country", "numBidRequests", "numEvents",
]


def roll_up_reduced(events: DataFrame, run_id: int) -> DataFrame:
    """Coarser roll-up for events that may lack columns; placeholders are typed NULLs."""
    types = dict(OUTPUT_TYPES)
    wanted = [Output(n, "min" if n == "osId" else "max") for n in REDUCED_OUTPUTS]
    wanted += [o for o in outputs(run_id) if o.name in COMPUTED]
    wanted += [
        Output(n, "value", value=F.lit(None).cast(types[n])) for n in REDUCED_PLACEHOLDERS
    ]
    return reduced_rollup(events, wanted, REDUCED_KEYS)
