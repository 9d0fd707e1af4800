"""Fixed values of the disclosure data set.

Everything in this module is a constant that must hold for results to be right:
word lists, alias tables, labels, label names on contract pages, page selectors.
No logic lives here.
"""

# --- fixed values: company suffixes, applied in this order ------------------
COMPANY_SUFFIXES = """
LIMITED, LIMITEE, LIMITE, LIMITACE, LTE, LT, LTEE, LLP, LP, PLC, LCC, LLC,
INCORPORATED, INC, LTD, LDT, CO, CORP, CORPORATION, PLC, PTY, ULC, LP, AB,
SENC, SENCRL, SENCRLSRL, SRL, LLPSEN, LTACE, GMBH, SA, SPZOO, SP ZOO,
SP Z OO, SP Z O O, BV, B V, SAS
"""

# --- fixed values: department code -> department code in use ----------------
OWNER_ALIASES = """
feddevontario: feddev
statcan: stats
pwgsc: pspc
jus: just
infc: infra
aandc: inac
aafc: agr
cic: ircc
dfatd: gac
irccpc: ircc
sc: esdc
"""

# --- fixed values: display labels -------------------------------------------
DISPLAY_LABELS = """
total_contracts: Total contracts
total_amendments: Total amendments
total_entries: Total entries
entries_below_25k: Entries below $25k
entries_above_25k: Entries above $25k
vendor_normalized: Company name
gen_vendor_normalized: Company name
sum_effective_value: Total effective value (2010 to 2019)
acoa: Atlantic Canada Opportunities Agency
agr: Agriculture and Agri-Food Canada
atssc: Administrative Tribunals Support Service of Canada
cannor: Canadian Northern Economic Development Agency
cas: Courts Administration Service
casdo: Accessibility Standards Canada
cbsa: Canada Border Services Agency
cc: Canada Council for the Arts
cer: Canada Energy Regulator
ccohs: Canadian Centre for Occupational Health and Safety
ceaa: Canadian Environmental Assessment Agency
ced: Canada Economic Development for Quebec Regions
cfia: Canadian Food Inspection Agency
cgc: Canadian Grain Commission
chrc: Canadian Human Rights Commission
cics: Canadian Intergovernmental Conference Secretariat
cihr: Canadian Institutes of Health Research
cnsc: Canadian Nuclear Safety Commission
cpc: Civilian Review and Complaints Commission for the RCMP
cra: Canada Revenue Agency
crtc: Canadian Radio-television and Telecommunications Commission
csa: Canadian Space Agency
csc: Correctional Service of Canada
csps: Canada School of Public Service
cta: Canadian Transportation Agency
dfo: Fisheries and Oceans Canada
dnd: National Defence
ec: Environment and Climate Change Canada
elections: Elections Canada
esdc: Employment and Social Development Canada
fcac: Financial Consumer Agency of Canada
feddev: Federal Economic Development Agency for Southern Ontario
fin: Department of Finance Canada
fintrac: Financial Transactions and Reports Analysis Centre of Canada
fja: Office of the Commissioner for Federal Judicial Affairs Canada
fpcc: Farm Products Council of Canada
gac: Global Affairs Canada
hc: Health Canada
iaac: Impact Assessment Agency of Canada
ic: Innovation, Science and Economic Development Canada
ijc: International Joint Commission
inac: Crown-Indigenous Relations and Northern Affairs Canada
infra: Infrastructure Canada
irb: Immigration and Refugee Board of Canada
ircc: Immigration, Refugees and Citizenship Canada
isc: Indigenous Services Canada
just: Department of Justice
lac: Library and Archives Canada
mgerc: Military Grievances External Review Committee
mpcc: Military Police Complaints Commission of Canada
nbc: National Battlefields Commission
neb: National Energy Board
nfb: National Film Board
nrc: National Research Council Canada
nrcan: Natural Resources Canada
nserc: Natural Sciences and Engineering Research Council of Canada
nsira: National Security and Intelligence Review Agency
oag: Office of the Auditor General of Canada
oci: The Correctional Investigator Canada
ocl: Office of the Commissioner of Lobbying of Canada
ocol: Office of the Commissioner of Official Languages
ocsec: Office of the Intelligence Commissioner
oic: Office of the Information Commissioner of Canada
opc: Office of the Privacy Commissioner of Canada
osfi: Office of the Superintendent of Financial Institutions Canada
osgg: Office of the Secretary to the Governor General
oto: Office of the Taxpayers Ombudsman
pbc: Parole Board of Canada
pc: Parks Canada
pch: Canadian Heritage
pco: Privy Council Office
phac: Public Health Agency of Canada
pmprb: Patented Medicine Prices Review Board Canada
polar: Polar Knowledge Canada
ppsc: Public Prosecution Service of Canada
pptc: Passport Canada
ps: Public Safety Canada
psc: Public Service Commission of Canada
psic: Office of the Public Sector Integrity Commissioner of Canada
pspc: Public Services and Procurement Canada
rcmp: Royal Canadian Mounted Police
sirc: Security Intelligence Review Committee
ssc: Shared Services Canada
sshrc: Social Sciences and Humanities Research Council of Canada
stats: Statistics Canada
swc: Status of Women Canada
tbs: Treasury Board of Canada Secretariat
tc: Transport Canada
tsb: Transportation Safety Board of Canada
vac: Veterans Affairs Canada
vrab: Veterans Review and Appeal Board
wage: Department for Women and Gender Equality
wd: Western Economic Diversification Canada
"""

# --- fixed values: contract ids flagged as errors by hand -------------------
MANUAL_ERROR_CONTRACT_IDS = ["pspc-0000101859"]

# --- fixed values: report range and sizes -----------------------------------
REPORT_YEARS = (2010, 2019)
TOP_VENDORS = 200
TOP_VENDORS_BY_YEAR = 10
SMALL_CONTRACT_LIMIT = 25000
BAND_LOW = 24000
BAND_HIGH = 26000
# rows of a report
REPORT_ROWS = 50000
YEARLY_ROWS = 10000
VENDOR_ENTRY_ROWS = 1000
DEPARTMENT_ROWS = 20000

# --- fixed values: positions in the bulk CSV file ---------------------------
CSV_WIDTH = 42
CSV_POSITIONS = """
0: csvReferenceNumber
1: referenceNumber
2: vendorName
5: contractDate
6: objectCode
7: description
9: contractPeriodStart
10: deliveryDate
11: contractValue
12: originalValue
14: comments
16: extraDescription
40: sourceFiscal
41: ownerAcronym
"""

# --- fixed values: label text on a contract page -> field -------------------
# "common" holds for every department; a department's own line for a field takes
# its place, and a line with "-" says that its pages have no such field.
PAGE_LABELS = """
common | Vendor Name | vendorName
common | Reference Number | referenceNumber
common | Contract Date | contractDate
common | Description of work | description
common | Contract Period | contractPeriodRange
common | Delivery Date | deliveryDate
common | Original Contract Value | originalValue
common | Contract Value | contractValue
common | Comments | comments
default | Description (more details) | extraDescription
cbsa | Additional description | extraDescription
cc | Vendor | vendorName
cc | Description | description
cc | Amount | contractValue
cfia | Date | contractDate
cfia | Detailed Description | extraDescription
cfia | Contract Start Date | contractPeriodStart
cfia | Contract End Date | contractPeriodEnd
dnd | Additional Comments | extraDescription
esdc | Description (more details) | extraDescription
esdc | Current Contract Value | contractValue
feddev | Description | description
feddev | Contract Period / Delivery Date | contractPeriodRange
feddev | Additional Comments | additionalComments
fja | Description (more details) | extraDescription
fja | Former Public Servant | formerPublicServant
hc | Description | description
hc | Document Type | extraDescription
hc | Overall Contract Value | contractValue
ic | Description | description
ic | Additional Comments | extraDescription
ic | Contract period / delivery date | contractPeriodRange
ic | Comment | comments
irccpc | Vender Name | vendorName
irccpc | Description (more details) | extraDescription
just | Additional Comments | extraDescription
lac | Contract Period / Delivery Date | contractPeriodRange
nrcan | Additional Comments | extraDescription
osfi | Work Description | description
pc | Additional Comments | extraDescription
pco | Brief Description (if applicable) | extraDescription
pco | Total Amended Contract Value | contractValue
phac | Description | description
phac | Document Type | extraDescription
phac | Overall Contract Value | contractValue
pspc | Description (more details) | extraDescription
pspc | Contract Period - From | contractPeriodStart
pspc | Contract Period - To | contractPeriodEnd
pspc | Contract Value | originalValue
pspc | Total Amended Contract Value | contractValue
sc | Description (more details) | extraDescription
sc | Current Contract Value | contractValue
ssc | Description | description
ssc | Detailed Description | extraDescription
stats | Vendor | vendorName
stats | Detailed Description | extraDescription
tbs | Detailed Description | extraDescription
wddeo | Contract Period / Delivery Date | contractPeriodRange
wddeo | - | deliveryDate
cbsa | - | originalValue
cc | - | deliveryDate
cc | - | originalValue
cc | - | comments
cfia | - | contractPeriodRange
dnd | - | originalValue
esdc | - | originalValue
irccpc | - | originalValue
sc | - | originalValue
"""
DEFAULT_LABEL_OWNERS = "acoa agr csa csps ec inac ircc ppsc ps rcmp tc"

# --- fixed values: cells of a contract page ---------------------------------
# owner | key cell | value cell; all others use //table//th and //table//td.
PAGE_CELLS = """
acoa | //div[@class='ACOADataFormLabelOneColumn'] | //div[@class='ACOADataFormFieldOneColumn']
agr | //table//th[@scope='row'] | //table//td
cbsa | //table[@class='contractDetail span-6']//th | //table[@class='contractDetail span-6']//td
cfia | //table//th[@scope='row'] | //table//td
csps | //div[@class='col-xs-6'][1] | //div[@class='col-xs-6'][2]
ec | //table//td[@scope='row'] | //table//td[@class='alignTopLeft']
feddev | //table//td[1] | //table//td[2]
fin | //div[@id='ContentPlaceHolder1_divDataDetail']//div[@class='span-2'] | //div[@id='ContentPlaceHolder1_divDataDetail']//div[@class='span-3']
hc | //h2 | //p
ic | //div[@class='formTable']//div[@class='ic2col1 formLeftCol'] | //div[@class='formTable']//div[@class='ic2col2 formRightCol']
inac | //table[@class='widthFull TableBorderBasic']//th | //table[@class='widthFull TableBorderBasic']//td
lac | //div[@id='WebPartWPQ1']//div[@style='float: left; width: 30%; padding: 2px 2px 12px 35px;'] | //div[@id='WebPartWPQ1']//div[@style='float: left; width: 60%; padding: 2px 2px 12px 0px;']
osfi | //table[@class='span-8']//th | //table[@class='span-8']//td
pc | //form//label | //form//p
pco | //table//td[@class='grantHeader'] | //table//tr/td[2]
phac | //h2 | //p
ssc | //table//th[@scope='row'] | //table//td
stats | //table//th[@scope='row'] | //table//td
tc | //table//th[@scope='row'] | //table//td
"""

# --- fixed values: text between the two dates of a contract period ----------
# All others use " to ".
PERIOD_SEPARATORS = {
    "To spaced": (" To ", "cc"),
    "dash spaced": (" - ", "cannor cnsc feddev ic inac ps"),
    "to unspaced": ("to", "dnd esdc fin hc pco phac pspc rcmp sc"),
}

# --- fixed values: heading that names the fiscal period ----------------------
# owner | heading selector | year pattern | quarter pattern
FISCAL_HEADINGS = """
acoa | //div[@class='center']//h2 | ([0-9]{4}) | ([0-9])[a-z]
agr | //main//table//caption | ([0-9]{4}) | ([0-9])<
cannor | //div[@class='center']//h2 | ([0-9]{4}) | ([0-9])[a-z]
cbsa | //h1[@id='wb-cont'] | ([0-9]{4}) | Q([0-9])
cc | //div[@role='main']//div[@class='score-right']//h2 | ([0-9]{4}) | ([0-9])<
cfia | //main/h1 | ([0-9]{4}) | months dash
cnsc | //div[@id='wb-main']//h2 | ([0-9]{4}) | ([0-9])<
csa | //div[@id='wb-main-in']/p[2]/strong | ([0-9]{4}) | -\\s([0-9])<
csps | //main//h1[@id='wb-cont'] | ([0-9]{4}) | ([0-9])<
dnd | //h1[@id='mc-cp'] | ([0-9]{4}) | ([0-9]):
ec | //div[@id='cn-centre-col-inner']//h1 | ([0-9]{4}) | ([0-9])<
esdc | //h2 | ([0-9]{4}) | \\s([0-9])<
feddev | //div[@role='main']//h1 | ([0-9]{4}) | first month
fin | //span[@id='ContentPlaceHolder1_lblQuarterTitle'] | ([0-9]{4}) | \\s([0-9])<
fintrac | //main//h2 | ([0-9]{4}) | ([0-9])[a-z]
fja | //div[@id='wb-main']//h2 | ([0-9]{4}) | ([0-9])<
hc | //div[@class='center']//h1 | ([0-9]{4}) | ([0-9])[a-z]
ic | //h1[@class='printHeader'] | ([0-9]{4}) | months to
inac | //title | ([0-9]{4}) | -\\s([0-9])[a-z]
infra | //h1[@id='wb-cont'] | ([0-9]{4}) | plain months
ircc | //h1[@id='wb-cont'] | ([0-9]{4}) | months dash
irccpc | //h1[@id='wb-cont'] | ([0-9]{4}) | months dash
just | //main//h2 | ([0-9]{4}) | ([0-9])<
lac | //main//h2 | ([0-9]{4}) | ([0-9])[a-z]
nrcan | //main//h2 | ([0-9]{4}) | ([0-9])[a-z]
osfi | //div[@id='wb-main']//h3 | ([0-9]{4}) | ([0-9])$
pc | //main//h2 | ([0-9]{4}) | ([0-9])[a-z]
pco | //div[@id='wb-main-in']//h3 | ([0-9]{4}) | \\s([0-9])<
phac | //div[@class='center']//h1 | ([0-9]{4}) | ([0-9])[a-z]
ppsc | //main//h2 | ([0-9]{4}) | ([0-9])[a-z]
ps | page url | y=([0-9]{4})&q=[0-9] | y=[0-9]{4}&q=([0-9])
pspc | //h1[@id='wb-cont'] | ([0-9]{4}) | \\s([0-9])<
rcmp | //h1[@id='wb-cont'] | ([0-9]{4}) | ,\\s([0-9])
sc | //h2 | ([0-9]{4}) | \\s([0-9])<
ssc | //h1[@id='wb-cont'] | ([0-9]{4}) | ordinal title
stats | //h1[@id='wb-cont'] | ([0-9]{4}) | ordinal sentence
tbs | //main//h1 | ([0-9]{4}) | ([0-9])[a-z]
tc | //form[@id='pageForm']/p[2]/strong | ([0-9]{4}) | ([0-9])<
wddeo | //div[@class='center']//h2 | ([0-9]{4}) | ([0-9])<
"""

# --- fixed values: phrase in a heading -> fiscal quarter ---------------------
QUARTER_PHRASES = """
months dash | January 1 - March 31 | 4
months dash | April 1 - June 30 | 1
months dash | July 1 - September 30 | 2
months dash | October 1 - December 31 | 3
months to | January 1 to March 31 | 4
months to | April 1 to June 30 | 1
months to | July 1 to September 30 | 2
months to | October 1 to December 31 | 3
plain months | January to March | 4
plain months | April to June | 1
plain months | July to September | 2
plain months | October to December | 3
first month | January | 4
first month | April | 1
first month | July | 2
first month | October | 3
ordinal title | Fourth Quarter | 4
ordinal title | First Quarter | 1
ordinal title | Second Quarter | 2
ordinal title | Third Quarter | 3
ordinal sentence | Fourth quarter | 4
ordinal sentence | First quarter | 1
ordinal sentence | Second quarter | 2
ordinal sentence | Third quarter | 3
"""
# Departments whose heading shows the calendar year: quarter 4 moves back a year.
CALENDAR_YEAR_OWNERS = "ircc ic feddev"

# --- fixed values: link hosts that are not followed --------------------------
FOREIGN_HOSTS = {
    "open.canada.ca": "cbsa cfia csa ssc stats",
    "collectionscanada.gc.ca": "lac",
}

# --- fixed values: literal repairs of a page before it is read ---------------
# owner | text on the page | text to use
PAGE_REPAIRS = """
stats | <td>Vendor:</td> | <th scope="row">Vendor:</th>
stats | <td>Reference Number:</td> | <th scope="row">Reference Number:</th>
stats | <td>Contract Date:</td> | <th scope="row">Contract Date:</th>
stats | <td>Description of Work:</td> | <th scope="row">Description of Work:</th>
stats | <td>Contract Period :</td> | <th scope="row">Contract Period :</th>
stats | <td>Contract Period:</td> | <th scope="row">Contract Period :</th>
stats | <td>Delivery Date:</td> | <th scope="row">Delivery Date:</th>
stats | <td>Contract Value:</td> | <th scope="row">Contract Value:</th>
stats | <td>Comments:</td> | <th scope="row">Comments:</th>
stats | <th class="row-stub" scope="row">Nom du vendeur:</th> | <th scope="row">Vendor:</th>
stats | <th class="row-stub" scope="row">Numéro de référence :</th> | <th scope="row">Reference Number:</th>
stats | <th class="row-stub" scope="row">Description&nbsp;of&nbsp;Work:</th> | <th scope="row">Description of Work:</th>
ircc | Vender Name | Vendor name
just | <h2>Important Information</h2> |
"""
FJA_PERIOD_WORDS = [" to/Ã ", " to/au ", " to/à "]
BROKEN_PAGE_MARKERS = {"csps": "HTTP error 404"}

# --- fixed values: part of the page that is kept -----------------------------
CONTENT_SELECTORS = {
    "//main": "agr cfia esdc fintrac just lac nrcan pc ppsc ps rcmp sc tbs",
    "//div[@class='center']": "acoa cannor hc inac pch phac wddeo",
    "//div[@id='wb-main-in']": "cbsa csa fin infra pco pspc ssc",
    "//div[@id='wb-main']": "cnsc fja osfi",
    "//div[@role='main']": "feddev ic stats",
    "//div[@role='main']//div[@class='score-right']": "cc",
    "//div[@id='mainContent_contdet']": "csps",
    "//div[@id='main']": "dnd",
    "//div[@id='cn-centre-col-inner']": "ec",
    "//form[@id='aspnetForm']": "ircc irccpc",
    "//form[@id='pageForm']": "tc",
}

# --- fixed values: accented letters and the plain letters used for them ------
ACCENTED = "ÀÁÂÃÄÅàáâãäåĀāĂăĄąÇçĆćĈĉĊċČčĎďĐđÈÉÊËèéêëĒēĔĕĖėĘęĚěĜĝĞğĠġĢģĤĥÌÍÎÏìíîïĨĩĪīĬĭĮįİıĴĵĶķĹĺĻļĽľŁłÑñŃńŅņŇňÒÓÔÕÖØòóôõöøŌōŎŏŐőŔŕŖŗŘřŚśŜŝŞşŠšŢţŤťÙÚÛÜùúûüŨũŪūŬŭŮůŰűŲųŴŵÝýÿŶŷŸŹźŻżŽž"
PLAIN_FOR_ACCENTED = "AAAAAAaaaaaaAaAaAaCcCcCcCcCcDdDdEEEEeeeeEeEeEeEeEeGgGgGgGgHhIIIIiiiiIiIiIiIiIiJjKkLlLlLlLlNnNnNnNnOOOOOOooooooOoOoOoRrRrRrSsSsSsSsTtTtUUUUuuuuUuUuUuUuUuUuWwYyyYyYZzZzZz"
LIGATURES = {"Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "ß": "ss"}
TYPOGRAPHIC = "‘’‚“”„–—•\u00a0"
PLAIN_FOR_TYPOGRAPHIC = "'',\"\"\"--o "
