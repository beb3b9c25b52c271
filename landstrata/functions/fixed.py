"""Fixed values of the published catalog: names, document constants and coordinate systems."""

from __future__ import annotations

# Names of the protected-area partitions.
STATE_NAMES = {
    "AK": "Alaska", "AL": "Alabama", "AR": "Arkansas", "AS": "American Samoa", "AZ": "Arizona",
    "CA": "California", "CO": "Colorado", "CT": "Connecticut", "DC": "District of Columbia",
    "DE": "Delaware", "FL": "Florida", "GA": "Georgia", "GU": "Guam", "HI": "Hawaii", "IA": "Iowa",
    "ID": "Idaho", "IL": "Illinois", "IN": "Indiana", "KS": "Kansas", "KY": "Kentucky",
    "LA": "Louisiana", "MA": "Massachusetts", "MD": "Maryland", "ME": "Maine", "MI": "Michigan",
    "MN": "Minnesota", "MO": "Missouri", "MP": "Northern Mariana Islands", "MS": "Mississippi",
    "MT": "Montana", "NC": "North Carolina", "ND": "North Dakota", "NE": "Nebraska",
    "NH": "New Hampshire", "NJ": "New Jersey", "NM": "New Mexico", "NV": "Nevada", "NY": "New York",
    "OH": "Ohio", "OK": "Oklahoma", "OR": "Oregon", "PA": "Pennsylvania", "PR": "Puerto Rico",
    "RI": "Rhode Island", "SC": "South Carolina", "SD": "South Dakota", "TN": "Tennessee",
    "TX": "Texas", "UM": "US Minor Outlying Islands", "UNKF": "Unknown (marine and offshore)",
    "UT": "Utah", "VA": "Virginia", "VI": "US Virgin Islands", "VT": "Vermont", "WA": "Washington",
    "WI": "Wisconsin", "WV": "West Virginia", "WY": "Wyoming",
}

# Names of the two-digit hydrologic regions.
REGION_NAMES = {
    "01": "New England", "02": "Mid Atlantic", "03": "South Atlantic-Gulf", "04": "Great Lakes",
    "05": "Ohio", "06": "Tennessee", "07": "Upper Mississippi", "08": "Lower Mississippi",
    "09": "Souris-Red-Rainy", "10": "Missouri", "11": "Arkansas-White-Red", "12": "Texas-Gulf",
    "13": "Rio Grande", "14": "Upper Colorado", "15": "Lower Colorado", "16": "Great Basin",
    "17": "Pacific Northwest", "18": "California", "19": "Alaska", "20": "Hawaii",
    "21": "Caribbean", "22": "South Pacific",
}

# What the units of each hydrologic level are called; two levels have no name.
LEVEL_NAMES = {
    2: "regions", 4: "subregions", 6: "basins", 8: "subbasins", 10: "watersheds",
    12: "subwatersheds", 14: "", 16: "",
}

# Levels that are delineated in part of the country only, and what their descriptions say about it.
PARTIAL_LEVELS = (14, 16)
PARTIAL_NOTE = (
    "This level covers a part of the country: units exist where a state has subdivided its subwatersheds. "
    "Where there is none, the area was not divided that far; the 12-digit units cover everything."
)

# The agency's pages on its two datasets, and on the terms its data may be used under.
PROTECTED_AREAS_PAGE = "https://www.usgs.gov/programs/gap-analysis-project/science/pad-us-data-overview"
WATERSHEDS_PAGE = "https://www.usgs.gov/national-hydrography/watershed-boundary-dataset"
USGS_TERMS = "https://www.usgs.gov/information-policies-and-instructions/copyrights-and-credits"

# Schema addresses and media types of the catalog documents.
STAC_VERSION = "1.1.0"
CATALOG_SCHEMA = "https://schemas.portolan-sdi.org/portolan/v0.2.0/schema.json"
PARTITION_SCHEMA = "https://schemas.portolan-sdi.org/incubating/partition/v1.0.0/schema.json"
FILE_SCHEMA = "https://stac-extensions.github.io/file/v2.1.0/schema.json"
TABLE_SCHEMA = "https://stac-extensions.github.io/table/v1.2.0/schema.json"
PROJ_SCHEMA = "https://stac-extensions.github.io/projection/v2.0.0/schema.json"
PARQUET_TYPE = "application/vnd.apache.parquet"
JSON_TYPE = "application/json"
GEOJSON_TYPE = "application/geo+json"

# Catalog names of column types; any other type keeps its own name.
CATALOG_TYPES = {
    "string": "varchar",
    "bigint": "bigint",
    "int": "integer",
    "double": "double",
    "binary": "geometry",
    "timestamp_ntz": "timestamp",
    "timestamp": "timestamp",
}
BBOX_TYPE = "struct(xmin double, ymin double, xmax double, ymax double)"
BBOX_DESCRIPTION = "West, south, east and north side of the feature; readers skip row groups by it."

# EPSG:4269 (NAD83 longitude, latitude) as PROJJSON.
EPSG_4269 = {
    "$schema": "https://proj.org/schemas/v0.5/projjson.schema.json",
    "type": "GeographicCRS",
    "name": "NAD83",
    "datum": {
        "type": "GeodeticReferenceFrame",
        "name": "North American Datum 1983",
        "ellipsoid": {
            "name": "GRS 1980", "semi_major_axis": 6378137, "inverse_flattening": 298.257222101,
        },
    },
    "coordinate_system": {
        "subtype": "ellipsoidal",
        "axis": [
            {"name": "Geodetic latitude", "abbreviation": "Lat", "direction": "north", "unit": "degree"},
            {"name": "Geodetic longitude", "abbreviation": "Lon", "direction": "east", "unit": "degree"},
        ],
    },
    "id": {"authority": "EPSG", "code": 4269},
}
