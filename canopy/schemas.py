"""Table schemas of the data model as DDL. REAL columns are widened to double."""

from canopy.constants import MONTHS, SEASONS
from canopy.functions.geo import MULTI, POINT, RING

_DAILY_TILE = ("ghi_max_wm2 double, dni_max_wm2 double, dhi_max_wm2 double, ghi_sum_whm2 double, "
               "dni_sum_whm2 double, dhi_sum_whm2 double, wind_avg_ms double, wind_max_ms double, "
               "temp_avg_c double, temp_max_c double, rainfall_mm double")
_PREDICTION = ("id int, tree_id string, type_id int, timestamp timestamp, value double, "
               "created_at timestamp, model_id string")
_WATERING = "tree_id string, amount_liters double, date date"

# Columns of the soil map between its key and its geometry, in source order.
SOIL_COLUMNS = (
    "schl5 bigint, nutz double, nutz_bez string, vgradstufe double, vgradstufe_bez string, "
    "boges_neu5 double, btyp string, bg_alt string, nutzgenese string, ausgangsm string, "
    "geomeinh double, geomeinh_bez string, aus_bg double, aus_bg_bez string, antro_bg double, "
    "antro_bg_bez string, torf_bg double, torf_bg_bez string, torf_klas double, flur double, "
    "flurstufe double, flurstufe_bez string, flurklasse double, flurklasse_bez string, "
    "bnbg_ob_h string, bnbg_ob_h_bez string, bnbg_ub_h string, bnbg_ub_h_bez string, "
    "bnbg_ob string, bngb_ob_bez string, bnbg_ub string, bnbg_ub_bez string, bart_gr double, "
    "sg_ob string, sg_ob_bez string, sg_ub string, sg_ub_bez string, sg_klas double, "
    "sg_klas_bez string, btyp_ka3 string, btyp_ka3_bez string, btyp_ka4 string, "
    "btyp_ka4_bez string, bform_ka5 string, bform_ka5_bez string, torf_ob string, "
    "torf_ob_bez string, torf_klas_bez string, torf_ub string, torf_ub_bez string")

SCHEMAS: dict[str, str] = {
    "trees": (
        "id string, standortnr string, kennzeich string, namenr string, art_dtsch string, art_bot string, "
        "gattung_deutsch string, gattung string, strname string, hausnr string, pflanzjahr double, "
        "standalter double, stammumfg double, baumhoehe double, bezirk string, eigentuemer string, "
        f"zusatz string, kronedurch double, geometry {POINT}, lat double, lng double, "
        "created_at timestamp, updated_at timestamp, street_tree boolean, baumscheibe double"),
    "soil": f"id string, {SOIL_COLUMNS}, geometry {MULTI}, created_at timestamp, updated_at timestamp",
    "issue_types": "id int, title string, description string, image_url string",
    "issues": "id int, issue_type_id int, created_at timestamp, tree_id string",
    "weather_stations": (
        "id bigint, von_datum date, bis_datum date, stationshoehe bigint, lat double, lon double, "
        f"stationsname string, bundesland string, geometry {POINT}"),
    "weather": (
        "stations_id bigint, date date, qn_3 bigint, wind_max_ms double, wind_avg_ms double, qn_4 bigint, "
        "rainfall_mm double, rskf bigint, sdk double, shk_tag bigint, nm bigint, vpm double, pm double, "
        "temp_avg_c double, upm double, temp_max_c double, tnk double, tgk double"),
    "radolan_tiles": f"id bigint, geometry {RING}",
    "radolan": "tile_id bigint, date date, rainfall_mm double, rainfall_max_mm double",
    "shading": "tree_id string, " + ", ".join(f"{s} double" for s in SEASONS),
    "shading_monthly": "tree_id string, " + ", ".join(f"{m} double" for m in MONTHS),
    "sensor_types": "id int, name string",
    "forecast": _PREDICTION,
    "nowcast": _PREDICTION,
    "customers": "id int, name string",
    "tree_devices": (
        "tree_id string, customer_id int, device_id bigint, site_id bigint, valid_from_date date, "
        "valid_to_date date"),
    "trees_private": (
        "tree_id string, vitality_index double, baumscheibe_m2 double, baumscheibe_surface string"),
    "sensor_measurements": (
        "tree_id string, type_id int, sensor_id int, timestamp timestamp, value double"),
    "watering_gdk": _WATERING,
    "watering_sga": _WATERING,
    "weather_tiles": f"id bigint, lat double, lng double, geometry {RING}",
    "weather_tile_measurement": f"tile_id bigint, date date, {_DAILY_TILE}",
    "weather_tile_forecast": f"tile_id bigint, date date, created_at timestamp, {_DAILY_TILE}",
    "rain_cells": "ts timestamp, x int, y int, rainfall_mm double",
    "lattice_corners": "x int, y int, lon double, lat double",
    "raster_cells": "raster_id string, row int, col int, value double",
    "raster_transform": (
        "raster_id string, x0 double, y0 double, dx double, dy double, n_rows int, n_cols int"),
}
