"""DuckDB SQL of the nested resources: JSON text built from the same tables, key by key, in the order of ``operators.resources``.

Each function returns SQL; JSON pieces are SQL expressions that are null where the part is absent.
"""

from __future__ import annotations

from ..operators import resources as r

SECRET = b"demo secret of the test data"
PRIV = r.Privacy("pseudonymize", SECRET)
_NS = PRIV.namespace.replace("-", "")


def hmac_sql(message: str) -> str:
    """HMAC-SHA256 under SECRET, as hex."""
    inner, outer = (bytes(b ^ x for b in SECRET.ljust(64, b"\0")).hex() for x in (0x36, 0x5C))
    return f"sha256(from_hex('{outer}') || from_hex(sha256(from_hex('{inner}') || encode({message}))))"


def base32_sql(h: str, letters: int) -> str:
    """The first letters of the base32 of the hex text ``h``."""
    return " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr({h}, {k // 4 * 5 + 1}, 5) AS BIGINT) // {32 ** (3 - k % 4)}) % 32 + 1 AS BIGINT), 1)" for k in range(letters))


def once(value: str, use: str) -> str:
    """``use`` (of h) with ``value`` computed once."""
    return f"list_transform([{value}], lambda h: {use})[1]"


def uid(kind: str, *parts: str) -> str:
    name = ", ".join([f"'{kind}'", *[f"CAST({p} AS VARCHAR)" for p in parts]])
    return once(f"sha1(from_hex('{_NS}') || encode(concat_ws('|', {name})))", "concat_ws('-', substr(h, 1, 8), substr(h, 9, 4), '5' || substr(h, 14, 3), substr('89ab', CAST('0x' || substr(h, 17, 1) AS BIGINT) % 4 + 1, 1) || substr(h, 18, 3), substr(h, 21, 12))")


def js(x: str) -> str:
    return f"CASE WHEN ({x}) IS NOT NULL THEN CAST(to_json(CAST({x} AS VARCHAR)) AS VARCHAR) END"


def num(x: str) -> str:
    return f"CASE WHEN ({x}) IS NOT NULL THEN CAST(to_json(CAST({x} AS DOUBLE)) AS VARCHAR) END"


def text(v: str) -> str:
    return f"'\"{v}\"'"


def obj(*pairs, **named) -> str:
    parts = ", ".join(f"'\"{k}\":' || {v}" for k, v in (*pairs, *named.items()))
    return f"('{{' || concat_ws(',', {parts}) || '}}')"


def arr(*items: str) -> str:
    """An array of the items that are not null, null if none is."""
    return f"CASE WHEN coalesce({', '.join(items)}) IS NOT NULL THEN '[' || concat_ws(',', {', '.join(items)}) || ']' END"


def when(test: str, value: str, other: str = "NULL") -> str:
    return f"CASE WHEN {test} THEN {value} ELSE {other} END"


def ref(target: str, kind: str, *parts: str) -> str:
    return when(" AND ".join(f"({p}) IS NOT NULL" for p in parts), obj(reference=f"('\"{target}/' || {uid(kind, *parts)} || '\"')"))


def fixed(system: str, code: str) -> str:
    """``code`` is a JSON piece."""
    return when(f"({code}) IS NOT NULL", obj(coding=f"('[' || {obj(system=text(system), code=code)} || ']')"))


def concept(system: str, code: str) -> str:
    k = f"trim(CAST({code} AS VARCHAR))"
    return when(f"{k} NOT IN ('', '0')", obj(coding=f"('[' || {obj(system=text(system), code=js(k))} || ']')"))


def period(a: str, b: str | None = None) -> str:
    return when(f"coalesce({a}, {b or 'NULL'}) IS NOT NULL", obj(start=a, **({"end": b} if b else {})))


def persons(source: str) -> str:
    """CTE pt: what privacy makes of every patient number of ``source`` (patient_id)."""
    return f""", pt AS MATERIALIZED (SELECT patient_id AS pid, {once(hmac_sql("CAST(patient_id AS VARCHAR)"), "'P' || " + base32_sql("h", 16))} AS pseudo,
CAST(CAST('0x' || substr({hmac_sql("'shift:' || CAST(patient_id AS VARCHAR)")}, 1, 8) AS BIGINT) % 731 - 365 AS INTEGER) AS days, {ref("Patient", "Patient", "patient_id")} AS pref FROM (SELECT DISTINCT patient_id FROM {source} WHERE patient_id IS NOT NULL))"""


def day(x: str) -> str:
    return js(f"CAST({x} AS DATE) + days")


def stamp(x: str) -> str:
    return js(f"strftime({x} + to_days(days), '%Y-%m-%dT%H:%M:%S')")


def rows(kind: str, id_: str, patient: str, source: str, /, *pairs, **named) -> str:
    """SELECT of resource_type, id, patient, body; ``source`` gives the columns."""
    body = obj(("resourceType", text(kind)), ("id", "('\"' || id || '\"')"), *pairs, **named)
    return f" SELECT '{kind}' AS resource_type, id, {patient} AS patient, {body} AS body FROM (SELECT *, {id_} AS id FROM {source})"


OFF = "trim(cancelled) IN ('X', '1')"
ISH, HL7 = r.ISH, r.HL7
OWNED = "LEFT JOIN pt ON pt.pid = patient_id"
DEID = (
    "regexp_replace(regexp_replace(regexp_replace(regexp_replace({0}, '\\b\\d{{1,2}}\\.\\d{{1,2}}\\.\\d{{2,4}}\\b', '[DATUM]', 'g'), '\\b[\\p{{L}}\\p{{N}}_.+-]+@[\\p{{L}}\\p{{N}}_-]+\\.[\\p{{L}}\\p{{N}}_.-]+\\b', '[EMAIL]', 'g'), "
    "'(?i)\\b(herr|frau|dr\\.?|prof\\.?)\\s+[A-ZÄÖÜ][a-zäöüß]+', '\\1 [NAME]', 'g'), '\\b[A-Z]{{1,3}}\\d{{6,}}\\b', '[ID]', 'g')"
)


def patient(birth: str = "substr(birth, 1, 4)", source: str = "patients") -> str:
    return rows("Patient", uid("Patient", "patient_id"), "pseudo", f"{source} {OWNED}",
        identifier=arr(obj(system=text("urn:pseudonym"), value=js("pseudo"))), gender=js("CASE trim(sex) WHEN '1' THEN 'male' WHEN '2' THEN 'female' WHEN '3' THEN 'other' ELSE 'unknown' END"), birthDate=js(birth),
        deceasedBoolean=when("dead = 'X'", "'true'"), deceasedDateTime=when("dead = 'X' AND dead_on IS NOT NULL", js("CAST(CAST(substr(dead_on, 1, 10) AS DATE) + days AS VARCHAR) || substr(dead_on, 11)")),
        link=when("merged_into IS NOT NULL", arr(obj(other=ref("Patient", "Patient", "merged_into"), type=text("replaces")))), generalPractitioner=when("doctor <> 0", arr(ref("Practitioner", "Practitioner", "doctor"))))


def case(members: str) -> str:
    persons_of = f"'{{\"individual\":' || pr || ',\"type\":' || {concept(ISH + 'farzt', chr(39) + '1' + chr(39))} || '}}'"
    parts = f"""{members}{persons("cases")}, un AS MATERIALIZED (SELECT person, {ref("Practitioner", "Practitioner", "person")} AS pr FROM (SELECT DISTINCT unit AS person FROM procedures)),
st AS (SELECT case_id, '[' || string_agg(DISTINCT {persons_of}, ',' ORDER BY {persons_of}) || ']' AS staff FROM procedures JOIN un ON unit = person WHERE NOT {OFF} GROUP BY 1),
mo AS (SELECT case_id, min_by(reason, (begin_ts, number)) FILTER (WHERE kind = '1') AS ra, min_by(reason, (begin_ts, number)) FILTER (WHERE kind = '2') AS rl FROM movements WHERE NOT {OFF} GROUP BY 1),
lk AS (SELECT case_id, case_id + 1 AS partner FROM mem WHERE lead = 'X' AND NOT {OFF}), ag AS (SELECT case_id, max(grp) AS grp FROM mem GROUP BY 1)"""
    a, b = concept(ISH + "tn14g", "ra"), concept(ISH + "tn14g", "rl")
    return parts + rows("Encounter", uid("Encounter", "cases.case_id"), "pseudo", f"cases {OWNED} LEFT JOIN st ON st.case_id = cases.case_id LEFT JOIN mo ON mo.case_id = cases.case_id LEFT JOIN lk ON lk.case_id = cases.case_id LEFT JOIN ag ON ag.case_id = cases.case_id",
        ("status", js(f"CASE WHEN {OFF} THEN 'entered-in-error' WHEN end_date IS NOT NULL THEN 'finished' ELSE 'in-progress' END")), ("class", obj(code=js("CASE case_type WHEN '2' THEN 'AMB' WHEN '3' THEN 'SS' ELSE 'IMP' END"))), ("subject", "pref"), ("period", period(day("begin_date"), day("end_date"))),
        ("participant", "staff"), ("extension", when("partner IS NOT NULL", arr(obj(url=text(ISH + "fallbezug"), valueReference=ref("Encounter", "Encounter", "partner"), valueCode=text("M"))))), ("account", when("grp IS NOT NULL", arr(ref("Account", "Account", "grp")))),
        ("hospitalization", when("coalesce(ra, rl) IS NOT NULL", obj(admitSource=a, dischargeDisposition=b))))


OWNER = ", ow AS (SELECT case_id, patient_id FROM cases)" + persons("cases")


def orgs(source: str) -> str:
    """CTE og: the reference of every unit number n of ``source``."""
    return f", og AS MATERIALIZED (SELECT n, {ref('Organization', 'OrgUnit', 'n')} AS oref FROM (SELECT DISTINCT n FROM ({source})))"


def movement() -> str:
    def place(k: str, kind: str) -> str:
        return when(f"{k} <> 0", obj(location=ref("Location", "Location", k), physicalType=fixed(HL7 + "location-physical-type", text(kind))))

    return OWNER + orgs("SELECT ward AS n FROM movements UNION SELECT dept FROM movements") + rows("Encounter", uid("EncounterMovement", "movements.case_id", "number"), "pseudo", f"movements JOIN ow ON ow.case_id = movements.case_id {OWNED} LEFT JOIN og a ON a.n = dept LEFT JOIN (SELECT n AS n2, oref AS oref2 FROM og) b ON n2 = ward",
        status=js(f"CASE WHEN {OFF} THEN 'entered-in-error' WHEN kind = '6' THEN 'onleave' ELSE 'finished' END"), type=arr(obj(text=js("CASE kind WHEN '1' THEN 'Aufnahme' WHEN '2' THEN 'Entlassung' WHEN '3' THEN 'Verlegung' WHEN '4' THEN 'ambulanter Besuch' WHEN '6' THEN 'Abwesenheit Beginn' WHEN '7' THEN 'Abwesenheit Ende' ELSE 'Bewegung' END"))),
        partOf=ref("Encounter", "Encounter", "case_id"), period=period(stamp("begin_ts"), stamp("end_ts")), serviceProvider="oref", extension=when("ward <> dept", arr(obj(url=text(ISH + "nursing-org"), valueReference="oref2"))), location=arr(place("room", "ro"), place("bed", "bd")), reasonCode=arr(concept(ISH + "tn14g", "reason")))


def condition(texts: str) -> str:
    def one(k: str, t: str) -> str:
        return obj(system=text(r.ICD), code=js(k), display=js(t))

    roles = arr(*[when(f"{k} = 'X'", obj(text=text(v))) for k, v in r.ROLES.items()])
    state = js(f"CASE WHEN {OFF} THEN 'entered-in-error' WHEN certainty = 'G' THEN 'confirmed' WHEN certainty = 'V' THEN 'provisional' WHEN certainty = 'A' THEN 'refuted' END")
    url = "https://fhir.de/StructureDefinition/icd-10-gm-diagnosesicherheit"
    return OWNER + texts + rows("Condition", uid("Condition", "di.case_id", "number"), "pseudo", f"diagnoses di JOIN ow ON ow.case_id = di.case_id {OWNED} LEFT JOIN (SELECT code AS tc, text AS t1 FROM texts) x ON tc = code LEFT JOIN (SELECT code AS tc2, text AS t2 FROM texts) y ON tc2 = code2",
        code=obj(coding=arr(one("code", "t1"), when("code2 <> code", one("code2", "t2"))), text=js("coalesce(nullif(trim(own_text), ''), t1)")), subject="pref", encounter=ref("Encounter", "Encounter", "case_id"), recordedDate=day("day"), category=roles, extension=when("trim(certainty) <> ''", arr(obj(url=text(url), valueCode=js("certainty")))),
        verificationStatus=fixed(HL7 + "condition-ver-status", state), clinicalStatus=when("certainty = 'Z'", fixed(HL7 + "condition-clinical", text("resolved"))))


def procedure() -> str:
    units = orgs("SELECT unit AS n FROM procedures") + ", un AS MATERIALIZED (SELECT person, " + ref("Practitioner", "Practitioner", "person") + " AS pr FROM (SELECT DISTINCT unit AS person FROM procedures))"
    member = obj(actor="pr", function=concept(ISH + "op-vorgang", "'OPT1'"))
    units += f", cw AS (SELECT procedure_id AS p2, string_agg(DISTINCT {member}, ',' ORDER BY {member}) AS crew FROM procedures JOIN un ON person = unit GROUP BY 1)"
    return OWNER + units + rows("Procedure", uid("Procedure", "procedure_id"), "pseudo", f"procedures p LEFT JOIN ow ON ow.case_id = p.case_id {OWNED} LEFT JOIN og ON n = unit LEFT JOIN cw ON p2 = procedure_id",
        status=js(f"CASE WHEN {OFF} THEN 'entered-in-error' ELSE 'completed' END"), code=concept(r.OPS, "code"), bodySite=arr(concept(ISH + "tn26e", "site")), subject=f"coalesce(pref, {ref('Encounter', 'Encounter', 'case_id')})", encounter=ref("Encounter", "Encounter", "case_id"),
        performedDateTime=day("day"), performer=arr(obj(actor="oref"), "crew"))


_STATE = "CASE upper(trim(status)) WHEN 'P' THEN 'preliminary' WHEN 'C' THEN 'corrected' ELSE 'final' END"


_LAB_DOCS = """, lv AS (SELECT *, CASE code WHEN 'view' THEN 'MIK' ELSE 'LAB' END AS doc_kind, patient_id AS doc_number, strftime(ts, '%y%m') AS doc_version, strftime(ts, '%d') AS doc_part, CASE WHEN unit = 'foo' THEN code ELSE code || ' in ' || unit END AS name FROM labs),
lc AS (SELECT patient_id, max(case_id) AS case_id FROM cases GROUP BY 1), hd AS (SELECT h.*, case_id FROM (SELECT doc_kind, doc_number, doc_version, doc_part, min(patient_id) AS patient_id, min(ts) AS head_ts, min(status) AS head_status FROM lv WHERE flag <> 'krass' GROUP BY 1, 2, 3, 4) h LEFT JOIN lc USING (patient_id))"""
_KEY = ", ".join(r.DOC)


def lab_report() -> str:
    o = ref("Observation", "ObsLab", *r.DOC, "lab_id")
    parts = persons("labs") + _LAB_DOCS + f", rs AS (SELECT {_KEY}, '[' || string_agg(DISTINCT {o}, ',' ORDER BY {o}) || ']' AS result FROM lv GROUP BY 1, 2, 3, 4)"
    return parts + rows("DiagnosticReport", uid("LabReport", *r.DOC), "pseudo", f"(SELECT *, head_status AS status FROM hd) h LEFT JOIN rs USING ({_KEY}) {OWNED}",
        status=js(_STATE), category=arr(fixed(HL7 + "v2-0074", text("LAB"))), code=obj(text=text("Laborbefund")), subject="pref", encounter=ref("Encounter", "Encounter", "case_id"), effectiveDateTime=stamp("head_ts"), issued=stamp("head_ts"), result="result")


def lab_value(lab: str) -> str:
    derived = "CASE WHEN flag = '+' THEN 'H' WHEN flag = 'LL' THEN 'LL' WHEN flag = 'krass' THEN NULL WHEN q > hi THEN 'H' WHEN q < lo THEN 'L' WHEN q IS NOT NULL AND (lo IS NOT NULL OR hi IS NOT NULL) THEN 'N' END"
    sense = when(f"({derived}) IS NOT NULL", "('[' || " + obj(system=text(HL7 + "v3-ObservationInterpretation"), code=js(derived)) + " || ']')")
    loinc = "CASE code WHEN 'view' THEN '1-1' WHEN 'purchase' THEN '2-2' END"
    value = lambda x: when(f"{x} IS NOT NULL", obj(value=num(x)))
    source = f"(SELECT lv.* EXCLUDE (patient_id), comp, q, lo, hi, hd.patient_id, case_id, CASE WHEN status <> 'Q' THEN ts ELSE head_ts END AS seen FROM lv JOIN (SELECT lab_id, comp, q, lo, hi FROM lq) y USING (lab_id) LEFT JOIN hd USING ({_KEY})) {OWNED}"
    return lab + persons("labs") + _LAB_DOCS + rows("Observation", uid("ObsLab", *r.DOC, "lab_id"), "pseudo", source,
        status=js(_STATE), category=arr(fixed(HL7 + "observation-category", text("laboratory"))), code=obj(coding=arr(when(f"{loinc} IS NOT NULL", obj(system=text(r.LOINC), code=js(loinc))), obj(system=text(ISH + "leistid"), code=js("code"))), text=js("name")),
        partOf=arr(ref("DiagnosticReport", "LabReport", *r.DOC)), subject="pref", encounter=ref("Encounter", "Encounter", "case_id"), effectiveDateTime=stamp("seen"),
        valueQuantity=when("q IS NOT NULL", obj(value=num("q"), unit=js("unit"), comparator=js("nullif(comp, '')"))), valueString=js("CASE WHEN q IS NULL THEN trim(raw) END"),
        referenceRange=when("lo IS NOT NULL OR hi IS NOT NULL OR normal = 'negativ'", arr(obj(low=value("lo"), high=value("hi"), text=js("CASE WHEN normal = 'negativ' THEN normal END")))),
        interpretation=when(f"flag = 'krass' OR ({derived}) IS NOT NULL", arr(obj(coding=sense, text=js("CASE WHEN flag = 'krass' THEN flag END")))))


def document() -> str:
    return "WITH x AS (SELECT doc_id, doc_id % 1000 + 1 AS patient_id, lang, source FROM documents)" + persons("x") + rows("DocumentReference", uid("DocRef", "doc_id"), "pseudo", f"x {OWNED}",
        status=js("CASE WHEN source = 'src1' THEN 'entered-in-error' ELSE 'current' END"), masterIdentifier=obj(system=text(ISH + "dms-dokid"), value=js("doc_id")), type=concept(ISH + "n2dt", "lang"), subject="pref", date=stamp("TIMESTAMP '2024-03-05 08:15:00'"),
        author=arr(ref("Practitioner", "Practitioner", "doc_id % 50"), ref("Organization", "OrgUnit", "doc_id % 10")))


def coverage() -> str:
    member = once(hmac_sql("'kvnr:' || name"), "'KVN' || " + base32_sql("h", 14))
    parts = persons("cases") + f", ins AS MATERIALIZED (SELECT patient_id AS ip, region, {member} AS member FROM patients)"
    return parts + rows("Coverage", uid("Coverage", "case_id"), "pseudo", f"cases {OWNED} LEFT JOIN ins ON ip = patient_id AND region = case_id % 25",
        status=js(f"CASE WHEN {OFF} THEN 'cancelled' ELSE 'active' END"), beneficiary=ref("Encounter", "Encounter", "case_id"), payor=arr(ref("Organization", "OrgPayer", "case_id % 25")), period=period(day("begin_date"), day("end_date")), type=obj(text=js("CASE WHEN case_id % 25 = 0 THEN 'Selbstzahler' ELSE specialty END")), subscriberId=js("member"))


def birth() -> str:
    items = ", ".join(f"('{t}', '{code}', '{u}', CAST({x} AS DOUBLE))" for (_, t, code, u), x in zip(r.BIRTH, ("case_id % 3000 + 1500", "case_id % 20 + 40", "CASE WHEN case_id % 3 = 0 THEN 34 END")))
    parts = persons("cases") + f", b AS (SELECT case_id, patient_id, begin_date, t, code, u, v FROM cases, LATERAL (VALUES {items}) x(t, code, u, v) WHERE v <> 0)"
    return parts + rows("Observation", uid("ObsBirth", "case_id", "t"), "pseudo", f"b {OWNED}", status=text("final"), code=obj(coding=arr(obj(system=text(r.LOINC), code=js("code"))), text=js("t")), encounter=ref("Encounter", "Encounter", "case_id"), effectiveDateTime=day("begin_date"), valueQuantity=obj(value=num("v"), unit=js("u")))


def location() -> str:
    return rows("Location", uid("Location", "unit_id"), "CAST(NULL AS VARCHAR)", "units", status=text("active"), name=js("unit_name"), physicalType=concept(ISH + "tn11b", "'ZI'"), partOf=when("unit_id > 10", ref("Location", "Location", "unit_id % 10")), managingOrganization=ref("Organization", "OrgUnit", "unit_id"))


def medication() -> str:
    drug = "CASE WHEN code_id % 2 = 0 THEN CAST(code_id AS VARCHAR) ELSE brand END"
    return OWNER + rows("MedicationRequest", uid("MedReq", "charge_id"), "pseudo", f"charges JOIN ow ON ow.case_id = charges.case_id {OWNED} JOIN (SELECT code_id AS c2, text, brand FROM codes) k ON c2 = code_id",
        status=js("CASE WHEN flag = 'R' THEN 'entered-in-error' ELSE 'active' END"), intent=text("order"), medicationCodeableConcept=obj(coding=arr(obj(system=js(f"CASE WHEN code_id % 2 = 0 THEN 'http://fhir.de/CodeSystem/ifa/pzn' ELSE '{ISH}drugid' END"), code=js(drug))), text=js("text")), subject="pref", encounter=ref("Encounter", "Encounter", "case_id"),
        authoredOn=day("day"), dosageInstruction=arr(obj(text=js("CAST(CAST(quantity AS INTEGER) AS VARCHAR) || '-0-0'"))), dispenseRequest=obj(quantity=obj(value=num("quantity"))), substitution=obj(allowedBoolean=when("flag = 'A'", "'false'", "'true'")))


def risk() -> str:
    code = "lpad(CAST(lab_id % 60 AS VARCHAR), 6, '0')"
    coded = obj(coding=arr(obj(system=text(ISH + "rsfnr"), code=js(code))), text=js("raw"))
    state = js("CASE WHEN lab_id % 11 = 0 THEN 'inactive' ELSE 'active' END")
    kinds = "x AS (SELECT *, CASE WHEN lab_id % 60 BETWEEN 1 AND 16 OR lab_id % 60 IN (22, 23) THEN 'allergy' WHEN lab_id % 60 IN (0, 17, 19, 20, 21, 24, 25, 26, 29, 30, 31, 34, 35, 36, 39, 41, 43, 45, 53) THEN 'infection' ELSE 'admin' END AS kind FROM labs)"
    category = js("CASE WHEN lab_id % 60 = 7 THEN 'biologic' WHEN lab_id % 60 IN (15, 23) THEN 'environment' WHEN lab_id % 60 BETWEEN 1 AND 14 THEN 'medication' END")
    one = rows("AllergyIntolerance", uid("Allergy", "lab_id"), "pseudo", f"x {OWNED} WHERE kind = 'allergy'", clinicalStatus=fixed(HL7 + "allergyintolerance-clinical", state), category=arr(category), code=coded, patient="pref", recordedDate=day("ts"))
    two = rows("Flag", uid("Flag", "lab_id"), "pseudo", f"x {OWNED} WHERE kind <> 'allergy'", status=state, category=arr(fixed(HL7 + "flag-category", js("CASE kind WHEN 'infection' THEN 'safety' ELSE 'admin' END"))), code=coded, subject="pref", period=period(day("ts")))
    return ", " + kinds + persons("labs") + one + " UNION ALL" + two


def organization(table: str, key: str, name: str, kind: str, type_code: str | None, system: str, *, ik: bool = True, parent: str | None = None) -> str:
    own = obj(system=text(system), value=js(key))
    number = obj(system=text("http://fhir.de/sid/arge-ik/iknr"), value=js(f"260000000 + {key}"))
    return rows("Organization", uid(kind, key), "CAST(NULL AS VARCHAR)", table, active="'true'", **({"type": arr(fixed(HL7 + "organization-type", text(type_code)))} if type_code else {}), name=js(f"nullif(trim({name}), '')"), identifier=arr(number, own) if ik else arr(own), **({"partOf": parent} if parent else {}))


def practitioner() -> str:
    src = "(SELECT s_suppkey AS person, s_acctbal >= 0 AS named, s_nationkey <> 3 AS placed FROM supplier WHERE s_acctbal >= 0 OR s_nationkey <> 3)"
    who = lambda system: obj(system=text(system), value=js("person"))
    return rows("Practitioner", uid("Practitioner", "person"), "CAST(NULL AS VARCHAR)", src, active=when("placed AND person % 10 = 0", "'false'", "'true'"), identifier=arr(when("named", who(ISH + "gpart")), when("placed", who(ISH + "pernr")), when("placed AND person <> 0", who("http://fhir.de/sid/kbv/lanr"))), qualification=when("placed", arr(concept(ISH + "tnkfa", "'0100'"))))


def account(members: str) -> str:
    lead = obj(url=text(ISH + "apx-lead-encounter"), valueReference=ref("Encounter", "Encounter", "case_id"))
    other = obj(url=text(ISH + "apx-reason"), valueString=js("reason"))
    part = when("lead = 'X'", lead, other)
    parts = members + persons("cases") + f", ex AS (SELECT grp AS g2, '[' || string_agg(DISTINCT {part}, ',' ORDER BY {part}) || ']' AS ext FROM mem GROUP BY 1), gr AS (SELECT grp, patient_id, mem.cancelled FROM mem JOIN cases USING (case_id) WHERE lead = 'X')"
    return parts + rows("Account", uid("Account", "grp"), "pseudo", f"gr {OWNED} LEFT JOIN ex ON g2 = grp", status=js(f"CASE WHEN {OFF} THEN 'entered-in-error' ELSE 'active' END"), type=fixed(HL7 + "v3-ActCode", text("PBILLACCT")), identifier=arr(obj(system=text(ISH + "apxnr"), value=js("grp"))), subject=arr("pref"), extension="ext")


def order() -> str:
    note = DEID.format("nullif(trim(text), '')")
    return "WITH x AS (SELECT conv_id * 1000 + turn AS order_id, conv_id % 100 + 1 AS patient_id, conv_id, text FROM conversations)" + persons("x") + rows("ServiceRequest", uid("ServiceRequest", "order_id"), "pseudo", f"x {OWNED}",
        status=text("active"), intent=text("order"), code=obj(text=js("substr(text, 1, 30)")), subject="pref", requester=when("conv_id % 2 = 0", ref("Practitioner", "Practitioner", "conv_id % 20"), ref("Organization", "OrgUnit", "conv_id % 10")), authoredOn=day("DATE '2024-05-01'"), note=when("nullif(trim(text), '') IS NOT NULL", arr(obj(text=js(note)))))
