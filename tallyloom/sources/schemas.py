"""Schemas of the fact and lookup tables and of feature collections. Table and column names are fixed values."""

FACTS = {
    "names_kde": "surname string, year int, freq int",
    "names_all": "surname string",
    "names_frq": "surname string, year int, freq int",
    "names_fns_hist": "surname string, forename string, sex string",
    "names_fns_cont": "surname string, forename string, sex string",
    "names_loc_hist": "surname string, regcnty string, parish string",
    "names_loc_cont": "surname string, msoa11cd string",
    "names_oac21": "surname string, oaccd string, oacnm string, type string",
    "names_loac21": "surname string, loaccd string, loacnm string, type string",
    "names_imd": "surname string, imddec int, type string",
    "names_imd_std": "surname string, avg double, sd double",
    "names_ahah22": "surname string, ahahdec int, type string",
    "names_iuc": "surname string, iuccd int, iucnm string",
    "names_bbs": "surname string, bbs string, bbsdec int",
    "names_eee": "surname string, code int, eee string",
}
LOOKUPS = {
    "lookup_loc_cont": "msoa11cd string, msoa11nm string, ladnm string",
    "lookup_iuc": "iuccd string, iucdesc string",
    "lookup_oac21": "supergroupnm string, groupcd string",
    "lookup_loac21": "supergroupnm string, groupcd string",
    "lookup_oac21_desc": "code string, desc string",
    "lookup_loac21_desc": "code string, desc string",
}
PROPERTIES = "level int, time bigint, times array<bigint>, coordTimes array<bigint>, linestringTimestamps array<bigint>"
FEATURES = (
    f"type string, features array<struct<type: string, properties: struct<{PROPERTIES.replace(' ', ': ').replace(',: ', ', ')}>, "
    "geometry: struct<type: string, coordinates: string>>>"
)
