"""Names, units, scales, levels and regions that results must carry.

Fixed values: they name the same things for every user of such statistics and are stated as they are used.
"""

from __future__ import annotations

# Statistics and their long names.
STAT_LONG = {
    "acorr": "Anomaly Correlation",
    "rms": "Root Mean Square Error",
    "rms_ran": "Random Component of RMS Error",
    "rms_bar": "Bias Component of RMS Error",
    "rms_dis": "Dissipation Component of RMS Error",
    "rms_dsp": "Dispersion Component of RMS Error",
    "rms_amp": "Amplitude Component of RMS Error",
    "rms_phz": "Phase Component of RMS Error",
    "mse": "Mean Square Error",
    "me": "Mean Error",
    "res1": "Residual from bar/amp/phz decomp",
    "res2": "Residual from bar/random decomp",
    "f": "fcst",
    "a": "ana",
    "f_c": "Forecast Minus Climatology",
}
SQUARED_STATS = ("mse", "rms_dis", "rms_dsp")
UNITLESS_STATS = ("acorr",)

# Variables with long name, unit and factor to display units.
VARIABLES = {
    "H": ("Heights", "m", 1.0),
    "U": ("U-Wind", "m/s", 1.0),
    "V": ("V-Wind", "m/s", 1.0),
    "T": ("Temperature", "K", 1.0),
    "Q": ("Specific Humidity", "g/kg", 1000.0),
    "P": ("Sea-Level Pressure", "hPa", 0.01),
    "PS": ("Surface Pressure", "hPa", 0.01),
    "Q2M": ("2m Specific Humidity", "g/kg", 1000.0),
    "T2M": ("2m Temperature", "K", 1.0),
    "U10M": ("10m U-Wind", "m/s", 1.0),
    "V10M": ("10m V-Wind", "m/s", 1.0),
    "D2M": ("2m Dew Point", "K", 1.0),
    "W": ("Vertical Velocity", "Pa/s", 1.0),
    "Z": ("Geopotential", "m2/s2", 1.0),
    "AOD": ("Total Aerosol Extinction AOT [550 nm]", "", 1.0),
    "LOGAOD": ("log(AOD+0.01)", "", 1.0),
    "PM25": ("PM2.5 Total Mass", "ug/m3", 1e6),
}

# Model levels and their pressures in hPa, in table order.
MODEL_LEVELS = (
    (72, 985), (71, 970), (68, 925), (63, 850), (56, 700), (53, 600), (51, 525),
    (48, 412), (45, 288), (44, 245), (43, 208), (41, 150), (39, 109), (34, 48),
)

# Box regions with name on scorecards, north, south, east, west; bounds belong to the box.
BOX_REGIONS = (
    ("GLO", "global", 90.0, -90.0, 180.0, -180.0),
    ("NHE", "n.hem", 80.0, 20.0, 180.0, -180.0),
    ("TRO", "tropics", 20.0, -20.0, 180.0, -180.0),
    ("SHE", "s.hem", -20.0, -80.0, 180.0, -180.0),
    ("NWQ", "nw.quad", 90.0, 0.0, 0.0, -180.0),
    ("NEQ", "ne.quad", 90.0, 0.0, 180.0, 0.0),
    ("SWQ", "sw.quad", 0.0, -90.0, 0.0, -180.0),
    ("SEQ", "se.quad", 0.0, -90.0, 180.0, 0.0),
    ("NAM", "america", 60.0, 20.0, -60.0, -140.0),
    ("EUR", "europe", 60.0, 30.0, 30.0, -10.0),
    ("NPO", "npolar", 90.0, 60.0, 180.0, -180.0),
    ("SPO", "spolar", -60.0, -90.0, 180.0, -180.0),
    ("XPO", "xpolar", 60.0, -60.0, 180.0, -180.0),
)
# Regions given by a mask, and by intersections; with the box that scorecards name for them.
MASK_REGIONS = (
    ("CUS", "conus", 0.0, 0.0, 0.0, 0.0),
    ("LND", "glob_l", 90.0, -90.0, 180.0, -180.0),
    ("NHL", "n.hem_l", 80.0, 20.0, 180.0, -180.0),
    ("TRL", "trop_l", 20.0, -20.0, 180.0, -180.0),
    ("SHL", "s.hem_l", -20.0, -80.0, 180.0, -180.0),
)
INTERSECTIONS = {"NHL": ("NHE", "LND"), "TRL": ("TRO", "LND"), "SHL": ("SHE", "LND")}

#: What a derived variable is made from.
DEPENDENCIES = {
    "D2m": ("Q2m", "PS"),
    "LOGAOD": ("AOD",),
    "Z": ("H",),
    "PM25": ("SSSMASS25", "DUSMASS25", "BCSMASS", "OCSMASS", "SO4SMASS", "NISMASS25", "NH4SMASS"),
}
#: Statistics on scorecards, and their names there.
SCORECARD_STATS = {"acorr": "cor", "rms": "rms", "rms_ran": "rms_ran", "rms_bar": "rms_bar", "rms_dis": "rms_dis", "rms_dsp": "rms_dsp"}
SCORECARD_HEADER = "count|date|domain_name|east|expver|forecast|level|levtype|north|variable|source|south|statistic|step|type|value|verify|west"


def unit_of(var: str, stat: str) -> str:
    """Unit of a statistic of a variable."""
    unit = VARIABLES.get(var.upper(), ("", "", 1.0))[1]
    if stat in UNITLESS_STATS:
        return "unitless"
    return f"({unit})^2" if stat in SQUARED_STATS else unit


def long_name_of(var: str, stat: str) -> str:
    """Long name of a statistic of a variable."""
    return f"{STAT_LONG[stat]} of {VARIABLES.get(var.upper(), (var, '', 1.0))[0]}"
