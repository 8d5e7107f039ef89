"""Static dimension tables of the monthly tourism/weather panel.

Each table is a literal of fixed size (at most a few dozen rows), so it is
always safe to broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the source pipeline's lookup maps for identical
# results). CSV text, natural order.
# ---------------------------------------------------------------------------

LOCATIONS = """code,province,latitude,longitude
alava,Alava,42.8467,-2.6727
albacete,Albacete,38.9942,-1.8564
alicante,Alicante,38.3452,-0.4810
almeria,Almeria,36.8340,-2.4637
asturias,Asturias,43.3614,-5.8593
avila,Avila,40.6565,-4.6818
badajoz,Badajoz,38.8794,-6.9707
barcelona,Barcelona,41.3874,2.1686
burgos,Burgos,42.3439,-3.6969
caceres,Caceres,39.4753,-6.3724
cadiz,Cadiz,36.5271,-6.2886
cantabria,Cantabria,43.4623,-3.8099
castellon,Castellon,39.9864,-0.0513
ceuta,Ceuta,35.8894,-5.3213
ciudad_real,Ciudad Real,38.9848,-3.9274
cordoba,Cordoba,37.8882,-4.7794
cuenca,Cuenca,40.0704,-2.1374
girona,Girona,41.9794,2.8214
granada,Granada,37.1773,-3.5986
guadalajara,Guadalajara,40.6330,-3.1661
gipuzkoa,Gipuzkoa,43.3183,-1.9812
huelva,Huelva,37.2614,-6.9447
huesca,Huesca,42.1401,-0.4089
illes_balears,Illes Balears,39.5696,2.6502
jaen,Jaen,37.7796,-3.7849
a_coruna,A Coruna,43.3623,-8.4115
la_rioja,La Rioja,42.4627,-2.4449
las_palmas,Las Palmas,28.1235,-15.4363
leon,Leon,42.5987,-5.5671
lleida,Lleida,41.6176,0.6200
lugo,Lugo,43.0097,-7.5568
madrid,Madrid,40.4168,-3.7038
malaga,Malaga,36.7213,-4.4214
melilla,Melilla,35.2923,-2.9381
murcia,Murcia,37.9922,-1.1307
navarra,Navarra,42.8125,-1.6458
ourense,Ourense,42.3358,-7.8639
palencia,Palencia,42.0097,-4.5288
pontevedra,Pontevedra,42.4310,-8.6444
salamanca,Salamanca,40.9701,-5.6635
santa_cruz_tenerife,Santa Cruz de Tenerife,28.4636,-16.2518
segovia,Segovia,40.9429,-4.1088
sevilla,Sevilla,37.3891,-5.9845
soria,Soria,41.7666,-2.4790
tarragona,Tarragona,41.1189,1.2445
teruel,Teruel,40.3456,-1.1065
toledo,Toledo,39.8628,-4.0273
valencia,Valencia,39.4699,-0.3763
valladolid,Valladolid,41.6523,-4.7245
bizkaia,Bizkaia,43.2630,-2.9350
zamora,Zamora,41.5035,-5.7446
zaragoza,Zaragoza,41.6488,-0.8891
"""

DAILY_WEATHER_VARS = ["temperature_2m_mean", "temperature_2m_max", "temperature_2m_min", "precipitation_sum",
                      "rain_sum", "precipitation_hours", "wind_speed_10m_mean", "wind_speed_10m_max"]

REGIONS = """region_code,region_name
AN,Andalucia
AR,Aragon
AS,Asturias
CB,Cantabria
CE,Ceuta
CL,Castilla y Leon
CM,Castilla-La Mancha
CN,Canarias
CT,Cataluna
EX,Extremadura
GA,Galicia
IB,Illes Balears
MC,Murcia
MD,Madrid
ML,Melilla
NC,Navarra
PV,Pais Vasco
RI,La Rioja
VC,Comunitat Valenciana
"""

PROVINCE_REGIONS = """province,region_code
Alava,PV
Albacete,CM
Alicante,VC
Almeria,AN
Asturias,AS
Avila,CL
Badajoz,EX
Barcelona,CT
Burgos,CL
Caceres,EX
Cadiz,AN
Cantabria,CB
Castellon,VC
Ceuta,CE
Ciudad Real,CM
Cordoba,AN
Cuenca,CM
Girona,CT
Granada,AN
Guadalajara,CM
Gipuzkoa,PV
Huelva,AN
Huesca,AR
Illes Balears,IB
Jaen,AN
A Coruna,GA
La Rioja,RI
Las Palmas,CN
Leon,CL
Lleida,CT
Lugo,GA
Madrid,MD
Malaga,AN
Melilla,ML
Murcia,MC
Navarra,NC
Ourense,GA
Palencia,CL
Pontevedra,GA
Salamanca,CL
Santa Cruz de Tenerife,CN
Segovia,CL
Sevilla,AN
Soria,CL
Tarragona,CT
Teruel,AR
Toledo,CM
Valencia,VC
Valladolid,CL
Bizkaia,PV
Zamora,CL
Zaragoza,AR
"""

PROVINCE_ALIASES = """alias,province
ALAVA,Alava
ALMERIA,Almeria
AVILA,Avila
CACERES,Caceres
CADIZ,Cadiz
CASTELLON,Castellon
CORDOBA,Cordoba
GERONA,Girona
GUIPUZCOA,Gipuzkoa
ISLAS BALEARES,Illes Balears
JAEN,Jaen
LA CORUNA,A Coruna
LEON,Leon
LERIDA,Lleida
MALAGA,Malaga
ORENSE,Ourense
VIZCAYA,Bizkaia
"""

AIRPORT_PROVINCES = """airport_normalized,province
A CORUNA,A Coruna
ADOLFO SUAREZ MADRID-BARAJAS,Madrid
AEROPUERTO INTL. REGION MURCIA,Murcia
ALBACETE,Albacete
ALGECIRAS-HELIPUERTO,Cadiz
ALICANTE-ELCHE,Alicante
ALICANTE-ELCHE MIGUEL HDEZ.,Alicante
ALMERIA,Almeria
ASTURIAS,Asturias
BADAJOZ,Badajoz
BARCELONA-EL PRAT,Barcelona
BARCELONA-EL PRAT J.T.,Barcelona
BILBAO,Bizkaia
BURGOS,Burgos
CEUTA-HELIPUERTO,Ceuta
CORDOBA,Cordoba
EL HIERRO,Santa Cruz de Tenerife
FGL GRANADA-JAEN,Granada
FUERTEVENTURA,Las Palmas
GIRONA,Girona
GIRONA-COSTA BRAVA,Girona
GRAN CANARIA,Las Palmas
HUESCA-PIRINEOS,Huesca
IBIZA,Illes Balears
JEREZ DE LA FRONTERA,Cadiz
LA GOMERA,Santa Cruz de Tenerife
LA PALMA,Santa Cruz de Tenerife
LANZAROTE,Las Palmas
LANZAROTE CESAR MANRIQUE,Las Palmas
LANZAROTE-CESAR MANRIQUE,Las Palmas
LEON,Leon
LOGRONO,La Rioja
MADRID-CUATRO VIENTOS,Madrid
MALAGA-COSTA DEL SOL,Malaga
MELILLA,Melilla
MENORCA,Illes Balears
MURCIA-SAN JAVIER,Murcia
PALMA DE MALLORCA,Illes Balears
PAMPLONA,Navarra
REUS,Tarragona
SABADELL,Barcelona
SALAMANCA,Salamanca
SAN SEBASTIAN,Gipuzkoa
SANTIAGO,A Coruna
SANTIAGO-ROSALIA DE CASTRO,A Coruna
SEVE BALLESTEROS-SANTANDER,Cantabria
SEVILLA,Sevilla
SON BONET,Illes Balears
TENERIFE NORTE,Santa Cruz de Tenerife
TENERIFE NORTE-C. LA LAGUNA,Santa Cruz de Tenerife
TENERIFE SUR,Santa Cruz de Tenerife
TENERIFE-NORTE,Santa Cruz de Tenerife
TENERIFE-SUR,Santa Cruz de Tenerife
VALENCIA,Valencia
VALLADOLID,Valladolid
VIGO,Pontevedra
VITORIA,Alava
ZARAGOZA,Zaragoza
"""

NATIONAL_REGION_CODE = "ES"
GOLD_FEATURE_SOURCE = "open_meteo_monthly+holidays+aena+dataestur_hotel"

# ---------------------------------------------------------------------------

_SCHEMAS = {
    "locations": (LOCATIONS, "code string, province string, latitude double, longitude double"),
    "regions": (REGIONS, "region_code string, region_name string"),
    "province_regions": (PROVINCE_REGIONS, "province string, region_code string"),
    "province_aliases": (PROVINCE_ALIASES, "alias string, province string"),
    "airport_provinces": (AIRPORT_PROVINCES, "airport_normalized string, province string"),
}


def dimension(spark: SparkSession, name: str) -> DataFrame:
    """A static dimension as a broadcast-marked DataFrame (size fixed above)."""
    text, schema = _SCHEMAS[name]
    lines = text.strip().splitlines()[1:]
    rows = [line.split(",") for line in lines]
    df = spark.createDataFrame(rows, ", ".join(f"{c.split()[0]} string" for c in schema.split(", ")))
    casts = [F.col(c.split()[0]).cast(c.split()[1]) for c in schema.split(", ")]
    return F.broadcast(df.select(*casts))
