"""Address abbreviations and their expansion."""

from __future__ import annotations

import string

from pyspark.sql import Column, functions as F

from recordloom.functions.text import WHITESPACE

# abbreviation=term, one per line.
ABBREVIATIONS = """
ALY=Alley
ANX=Annex
ARC=Arcade
APT=Apartment
APT.=Apartment
APT#=Apartment
Attn=Attention
AV=Avenue
AVE=Avenue
AVE.=Avenue
AUT=Autoroute
BCH=Beach
BG=Burgs
BLDG=Building
BLF=Bluffs
BLVD=Boulevard
BLVD.=Boulevard
BND=Bend
BOUL=Boulevard
BR=Branch
BRG=Bridge
BRK=Brooks
BSMT=Basement
BTM=Bottom
BYP=Bypass
BYU=Bayou
CAR=Carre
CARREF=Carrefour
CIR=Circles
CLB=Club
CLFS=Cliffs
COR=Corner
CORS=Corners
CP=Camp
CPE=Cape
CRES=Crescent
CRK=Creek
CRSE=Course
CSWY=Causeway
CT=Court
CTR=Centers
CTS=Courts
CV=Coves
CYN=Canyon
DEPT=Department
DL=Dale
DM=Dam
DR=Drives
DR.=Drives
DV=Divide
EST=Estates
EXPY=Expressway
EXT=Extension
FL=Floor
FLR=Floor
FL2=2nd floor
2FL=2nd floor
1FL=1st floor
Flr=Floor
FLD=Field
FLDS=Fields
FLS=Falls
FLT=Flats
FRD=Fords
FRNT=Front
FRG=Forges
FRK=Forks
FRST=Forests
FRY=Ferry
FT=Fort
FWY=Freeway
GDNS=Gardens
GLN=Glens
GRN=Greens
GRV=Groves
GTWY=Gateway
HBR=Harbors
HC=Highway Contract
HL=Hill
HLS=Hills
HOLW=Hollow
HTS=Heights
HVN=Haven
HWY=Highway
Hyw=Highway
Hy=Highway
INLT=Inlet
IS=Island
ISS=Islands
JCT=Junction
KNLS=Knolls
KY=Keys
LCKS=Locks
LDG=Lodge
LF=Loaf
LGT=Lights
LK=Lake
LKS=Lakes
LN=Lanes
LNDG=Landing
MDWS=Meadows
MI=Mile
ML=Mill
MLS=Mills
MNR=Manors
MP=Milepost
MSN=Mission
MT=Mount
MTN=Mountain
NCK=Neck
NE=Northeast
NW=Northwest
OFC=Office
ORCH=Orchard
PH=Penthouse
PKY=Parkway
PKWY=Parkway
PL=Place
PLN=Plain
PLNS=Plaines
PLZ=Plaza
PNES=Pines
PR=Prairie
PRT=Ports
PT=Points
RADL=Radial
RD=Road
RD.=Road
RM=Room
RDG=Ridges
RFD=Rural Free Delivery
RIV=River
RNCH=Ranches
RPDS=Rapids
RR=Rural Route
RR1=Rural Route 1
R.R.=Rural Route
RST=Rest
RT=Route
RTE=Route
St=Street
SE=Southeast
Rt=Route
SHL=Shoal
SHLS=Shoals
SHR=Shore
SHRS=Shores
SMT=Summit
SPC=Space
SPG=Spring
SPGS=Springs
SQ=Square
ST=Street
STA=Station
STE=Suite
STE.=Suite
STRA=Stravenue
STRM=Stream
SUIT=Suite
SW=Southwest
TER=Terrace
TPKE=Turnpike
TRAK=Tracks
TRCE=Traces
TRL=Trails
TRLR=Trailer
TUNL=Tunnel
UN=Unions
VIA=Viaduct
VIS=Vista
VL=Ville
VLG=Village
VLY=Valleys
VW=Views
WLS=Wells
XING=Crossing
"""


def abbreviation_table(text: str = ABBREVIATIONS) -> dict[str, str]:
    """Lookup keyed by upper-cased word without punctuation, the form tokens are looked up in."""
    table: dict[str, str] = {}
    for line in text.strip().splitlines():
        key, term = line.split("=", 1)
        key = key.translate(str.maketrans("", "", string.punctuation)).upper()
        table.setdefault(key, term)
    return table


def expand_abbreviations(address: Column, table: dict[str, str] | None = None) -> Column:
    """Replace every token whose leading word is a known abbreviation.

    Whatever follows the word inside its token (``,`` ``.`` ``#`` ...) is kept; tokens
    are joined again by one blank.
    """
    table = abbreviation_table() if table is None else table
    lookup = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])

    def expand(token: Column) -> Column:
        word = F.regexp_extract(token, r"^[^,.\s#]+", 0)
        term = F.try_element_at(lookup, F.upper(word))
        rest = F.substring(token, F.length(word) + 1, F.length(token))
        return F.when(term.isNotNull(), F.concat(term, rest)).otherwise(token)

    tokens = F.split(F.btrim(address, F.lit(WHITESPACE)), r"(?U)\s+")
    return F.array_join(F.transform(tokens, expand), " ")
