"""Tables as nested resources: (resource_type, id, patient, body), body as JSON text.

Every job is one projection over a table and its small joins; empty parts are
null and so absent from the JSON.  Column names are those of the views in
``ebbline.plans.base``; ids are version-5 UUIDs over the source keys.
"""

from __future__ import annotations

import hashlib
import hmac
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as c

#: Namespace of ids in clear; otherwise the secret makes another, so that ids cannot be tried out from numbers.
NAMESPACE = "8a3d5c0e-52b7-5d4f-9c11-7d2f0b6a4e90"
HL7, ISH = "http://terminology.hl7.org/CodeSystem/", "urn:ish:"
ICD, OPS, LOINC = "http://fhir.de/CodeSystem/bfarm/icd-10-gm", "http://fhir.de/CodeSystem/bfarm/ops", "http://loinc.org"


@dataclass(frozen=True)
class Privacy:
    """off: clear data; pseudonymize: stable pseudonyms, salted ids and shifted dates; anonymize: birth as decade besides."""

    mode: str = "off"
    secret: bytes = b""

    @property
    def clear(self) -> bool:
        return self.mode == "off"

    @property
    def namespace(self) -> str:
        return NAMESPACE if self.clear else str(uuid.UUID(bytes=hmac.new(self.secret, b"namespace", hashlib.sha256).digest()[:16]))

    def date(self, patient: Column, iso: Column) -> Column:
        return iso if self.clear else c.date_shift(self.secret, patient, iso)

    def patient(self, patient: Column) -> Column:
        return patient.cast("string") if self.clear else c.pseudonym(self.secret, patient)

    def people(self, rows: DataFrame) -> DataFrame:
        """``rows`` with what their patient becomes: ``_pseudo``, ``_days`` to move dates by, ``_subject``.

        Made once per patient and joined, so that keyed hashes do not run in every
        row; rows without a patient keep all three null.
        """
        one = rows.select("patient_id").where("patient_id is not null").distinct()
        days = F.lit(0) if self.clear else c.shift_days(self.secret, F.col("patient_id"))
        one = one.select("patient_id", self.patient(F.col("patient_id")).alias("_pseudo"), days.alias("_days"), self.ref("Patient", "Patient", "patient_id").alias("_subject"))
        return rows.join(one, "patient_id", "left")

    def moved(self, iso: Column) -> Column:
        """A date of a row that went through ``people``; hidden where the patient is not known."""
        return iso if self.clear else c.date_moved(iso, F.col("_days"))

    def text(self, t: Column) -> Column:
        return t if self.clear else c.deid_text(t)

    def birth(self, iso: Column) -> Column:
        """The date of birth as it may be told: whole, its year, or its decade."""
        return iso if self.clear else F.concat(F.substring(iso, 1, 3), F.lit("0s")) if self.mode == "anonymize" else F.substring(iso, 1, 4)

    def rid(self, kind: str, *parts) -> Column:
        return c.stable_id(self.namespace, kind, *[F.col(p) if isinstance(p, str) else p for p in parts])

    def ref(self, target: str, kind: str, *parts) -> Column:
        """A reference, null where a part is null."""
        cols = [F.col(p) if isinstance(p, str) else p for p in parts]
        known = reduce(lambda a, b: a & b, [p.isNotNull() for p in cols])
        return F.when(known, F.struct(F.concat(F.lit(target + "/"), self.rid(kind, *cols)).alias("reference")))

    def ids(self, df: DataFrame, own: tuple, **others: tuple) -> DataFrame:
        """``df`` with ids as columns: its own as ``_id``, others by name, null where a part is null.

        The hashes are columns of a step before, which the optimiser keeps apart
        because they are used several times; inlined, each use would hash anew.
        """
        parts = lambda key: [(F.col(p) if isinstance(p, str) else p).cast("string") for p in key[1:]]
        names = {"_id": F.concat_ws("|", F.lit(own[0]), *parts(own))}
        names |= {n: F.concat(F.lit(key[0]), *[x for p in parts(key) for x in (F.lit("|"), p)]) for n, key in others.items()}
        hashed = df.withColumns({f"_hash{n}": c.name_hash(self.namespace, name) for n, name in names.items()})
        return hashed.withColumns({n: c.hash_uuid(F.col(f"_hash{n}")) for n in names}).drop(*[f"_hash{n}" for n in names])


CLEAR = Privacy()


def to(target: str, id_: str) -> Column:
    """A reference by a column that holds the id, null where it is."""
    return F.when(F.col(id_).isNotNull(), F.struct(F.concat(F.lit(target + "/"), F.col(id_)).alias("reference")))


def concept(system: str, code: Column, text: Column | None = None) -> Column:
    """A coded value, null without a code."""
    k = c.code_concept(code.cast("string"))
    coding = F.array(F.struct(F.lit(system).alias("system"), k.alias("code")))
    return F.when(k.isNotNull(), F.struct(coding.alias("coding"), *([text.alias("text")] if text is not None else [])))


def fixed(system: str, code: Column) -> Column:
    return F.when(code.isNotNull(), F.struct(F.array(F.struct(F.lit(system).alias("system"), code.alias("code"))).alias("coding")))


def some(*items: Column) -> Column:
    """The items that are not null as an array; null if none is."""
    a = F.array_compact(F.array(*items))
    return F.when(F.size(a) > 0, a)


def period(start: Column, end: Column) -> Column:
    return F.when(start.isNotNull() | end.isNotNull(), F.struct(start.alias("start"), end.alias("end")))


def emit(df: DataFrame, kind: Column | str, id_: Column, patient: Column, /, **body: Column) -> DataFrame:
    name = F.lit(kind) if isinstance(kind, str) else kind
    fields = F.struct(name.alias("resourceType"), id_.alias("id"), *[v.alias(k) for k, v in body.items()])
    return df.select(name.alias("resource_type"), id_.alias("id"), patient.cast("string").alias("patient"), F.to_json(fields).alias("body"))


def _wrong(col: str = "cancelled") -> Column:
    return c.is_cancelled(F.col(col))


def text_date(col: Column) -> Column:
    return c.real_date(col.cast("string"))


def _stamp(col) -> Column:
    return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss")


def redacted(p: DataFrame, privacy: Privacy) -> DataFrame:
    """Patients without name, address and doctor: their own columns but these, the pseudonym for the number, birth as it may be told."""
    gone = ("name", "street", "city", "postcode", "country", "doctor", "merged_into")
    if privacy.clear:
        return p
    return p.select(privacy.patient(F.col("patient_id")).alias("patient_id"), *[privacy.birth(F.col(k)).alias(k) if k == "birth" else privacy.date(F.col("patient_id"), F.col(k)).alias(k) if k == "dead_on" else F.col(k) for k in p.columns if k not in (*gone, "patient_id")])


def patients(p: DataFrame, privacy: Privacy = CLEAR) -> DataFrame:
    """Sex, birth, death and its time, merge link, family doctor; name and address only in clear, else pseudonym and birth year (decade if anonymous)."""
    pid = F.col("patient_id")
    link = F.when(F.col("merged_into").isNotNull(), F.array(F.struct(privacy.ref("Patient", "Patient", "merged_into").alias("other"), F.lit("replaces").alias("type"))))
    address = F.when(F.coalesce("street", "city").isNotNull(), F.array(F.struct(some(F.col("street")).alias("line"), F.col("city"), F.col("postcode").alias("postalCode"), F.col("country"))))
    name = F.when(F.col("name").isNotNull(), F.array(F.struct(F.col("name").alias("family"))))
    dead = c.is_set(F.col("dead"))
    return emit(p, "Patient", privacy.rid("Patient", "patient_id"), privacy.patient(pid),
        identifier=F.array(F.struct(F.lit(ISH + "patnr" if privacy.clear else "urn:pseudonym").alias("system"), privacy.patient(pid).alias("value"))), gender=c.lookup(F.col("sex"), c.SEXES, "unknown"), birthDate=privacy.birth(F.col("birth")),
        deceasedBoolean=F.when(dead, True), deceasedDateTime=F.when(dead, privacy.date(pid, F.col("dead_on"))), link=link, generalPractitioner=some(privacy.ref("Practitioner", "Practitioner", c.valid_ref(F.col("doctor").cast("string")))),
        **({"name": name, "address": address} if privacy.clear else {}))


def cases(k: DataFrame, movements: DataFrame, staff: DataFrame, links: DataFrame, accounts: DataFrame, privacy: Privacy = CLEAR) -> DataFrame:
    """Class, state, period, staff, links to partner cases, billing group, admission source and discharge disposition.

    Movements are read once, and the id of a person is made once, not in every row.
    """
    first = lambda kind: F.min_by(F.when(F.col("kind") == kind, F.col("reason")), F.when(F.col("kind") == kind, F.struct("begin_ts", "number")))
    moves = movements.where(~_wrong() & F.col("kind").isin("1", "2")).groupBy("case_id").agg(first("1").alias("_admit"), first("2").alias("_leave"))
    who = staff.where(~_wrong()).select("case_id", "person", "role").distinct()
    ids = who.select("person").distinct().select("person", privacy.ref("Practitioner", "Practitioner", "person").alias("_ref"))
    people = who.join(ids, "person", "left").groupBy("case_id").agg(F.array_sort(F.collect_set(F.struct(F.col("_ref").alias("individual"), concept(ISH + "farzt", F.col("role")).alias("type")))).alias("_staff"))
    partner = privacy.ids(links.where(~_wrong()), ("Encounter", "case_id"), _partner=("Encounter", "partner"))
    partner = partner.groupBy("case_id").agg(F.array_sort(F.collect_set(F.struct(F.lit(ISH + "fallbezug").alias("url"), to("Encounter", "_partner").alias("valueReference"), F.col("role").alias("valueCode")))).alias("_links"))
    group = accounts.groupBy("case_id").agg(F.max("grp").alias("_grp"))
    df = privacy.people(k)
    for part in (moves, people, partner, group):
        df = df.join(part, "case_id", "left")
    df = privacy.ids(df.withColumns({"_b": text_date(F.col("begin_date")), "_e": text_date(F.col("end_date"))}), ("Encounter", "case_id"), _account=("Account", "_grp"))
    df, end = df.withColumns({"_from": privacy.moved(F.col("_b")), "_till": privacy.moved(F.col("_e"))}), F.col("_e")
    state = F.when(_wrong(), "entered-in-error").when(end.isNotNull(), "finished").otherwise("in-progress")
    source, gone = concept(ISH + "tn14g", F.col("_admit")), concept(ISH + "tn14g", F.col("_leave"))
    return emit(df, "Encounter", F.col("_id"), F.col("_pseudo"),
        status=state, **{"class": F.struct(c.lookup(F.col("case_type"), c.CASE_TYPES, "IMP").alias("code"))}, subject=F.col("_subject"), period=period(F.col("_from"), F.col("_till")),
        participant=F.col("_staff"), extension=F.col("_links"), account=some(to("Account", "_account")), hospitalization=F.when(source.isNotNull() | gone.isNotNull(), F.struct(source.alias("admitSource"), gone.alias("dischargeDisposition"))))


def movements(m: DataFrame, owner: DataFrame, privacy: Privacy = CLEAR) -> DataFrame:
    """Sub-encounters: type, part of the case, period, department, ward, room and bed, reason; leave and error states."""
    df = m.join(privacy.people(owner.select("case_id", "patient_id")), "case_id").withColumns({"_b": _stamp("begin_ts"), "_e": _stamp("end_ts")})
    at = lambda k: ("Location", c.valid_ref(F.col(k).cast("string")))
    df = privacy.ids(df, ("EncounterMovement", "case_id", "number"), _case=("Encounter", "case_id"), _dept=("OrgUnit", "dept"), _ward=("OrgUnit", "ward"), _room=at("room"), _bed=at("bed"))
    df = df.withColumns({"_from": privacy.moved(F.col("_b")), "_till": privacy.moved(F.col("_e"))})
    state = F.when(_wrong(), "entered-in-error").when(F.col("kind") == "6", "onleave").otherwise("finished")
    nursing = F.when(F.col("ward") != F.col("dept"), F.array(F.struct(F.lit(ISH + "nursing-org").alias("url"), to("Organization", "_ward").alias("valueReference"))))
    place = lambda k, kind: F.when(F.col(k).isNotNull(), F.struct(to("Location", k).alias("location"), fixed(HL7 + "location-physical-type", F.lit(kind)).alias("physicalType")))
    return emit(df, "Encounter", F.col("_id"), F.col("_pseudo"),
        status=state, type=F.array(F.struct(c.lookup(F.col("kind"), c.MOVEMENT_TYPES, "Bewegung").alias("text"))), partOf=to("Encounter", "_case"), period=period(F.col("_from"), F.col("_till")), serviceProvider=to("Organization", "_dept"), extension=nursing, location=some(place("_room", "ro"), place("_bed", "bd")), reasonCode=some(concept(ISH + "tn14g", F.col("reason"))))


#: What a diagnosis may be used as (not exclusive), and the states that its certainty stands for.
ROLES = {
    "principal": "Krankenhaushauptdiagnose", "department": "Fachabteilungshauptdiagnose", "admission": "Aufnahmediagnose", "discharge": "Entlassdiagnose", "referral": "Einweisungsdiagnose", "treatment": "Behandlungsdiagnose",
    "surgery": "OP-Diagnose", "preoperative": "praeoperative Diagnose", "death": "Todesursachen-Diagnose", "working": "Arbeitsdiagnose",
}
CERTAINTY = {"G": "confirmed", "V": "provisional", "A": "refuted"}


def conditions(d: DataFrame, owner: DataFrame, texts: DataFrame, privacy: Privacy = CLEAR) -> DataFrame:
    """Codes with their catalog texts (a second one only if it differs), the diagnosis's own text before the catalog's, ten roles (not exclusive), certainty and what it says of the state."""
    second = texts.select(F.col("code").alias("code2"), F.col("text").alias("text2"))
    df = d.join(privacy.people(owner.select("case_id", "patient_id")), "case_id").join(texts, "code", "left").join(second, "code2", "left")
    df = privacy.ids(df, ("Condition", "case_id", "number"), _case=("Encounter", "case_id"))
    roles = some(*[F.when(c.is_set(F.col(k)), F.struct(F.lit(v).alias("text"))) for k, v in ROLES.items()])
    code, code2, sure = (F.nullif(F.trim(k), F.lit("")) for k in ("code", "code2", "certainty"))
    one = lambda k, text: F.struct(F.lit(ICD).alias("system"), k.alias("code"), F.col(text).alias("display"))
    coding = F.array_compact(F.array(F.when(code.isNotNull(), one(code, "text")), F.when(code2.isNotNull() & ~code2.eqNullSafe(code), one(code2, "text2"))))
    state = F.when(_wrong(), "entered-in-error").otherwise(c.lookup(sure, CERTAINTY))
    told = F.when(sure.isNotNull(), F.array(F.struct(F.lit("https://fhir.de/StructureDefinition/icd-10-gm-diagnosesicherheit").alias("url"), sure.alias("valueCode"))))
    return emit(df, "Condition", F.col("_id"), F.col("_pseudo"),
        code=F.struct(coding.alias("coding"), privacy.text(F.coalesce(F.nullif(F.trim("own_text"), F.lit("")), "text")).alias("text")), subject=F.col("_subject"), encounter=to("Encounter", "_case"), recordedDate=privacy.moved(F.col("day").cast("string")), category=roles,
        extension=told, verificationStatus=fixed(HL7 + "condition-ver-status", state), clinicalStatus=fixed(HL7 + "condition-clinical", F.when(sure == "Z", "resolved")))


def procedures(p: DataFrame, owner: DataFrame, team: DataFrame, privacy: Privacy = CLEAR) -> DataFrame:
    """Code, day, body site, performing unit and team; the subject comes from the case.

    Team members travel as numbers beside their procedure, which meets them before it
    meets its patient; references, much longer, are made in the row of the result.
    """
    crew = team.select("procedure_id", "person", "task").repartition("procedure_id").groupBy("procedure_id").agg(F.collect_set(F.struct("person", "task")).alias("_team"))
    df = p.join(crew, "procedure_id", "left").join(privacy.people(owner.select("case_id", "patient_id")), "case_id", "left")
    member = lambda x: F.struct(privacy.ref("Practitioner", "Practitioner", x["person"]).alias("actor"), concept(ISH + "op-vorgang", x["task"]).alias("function"))
    several = F.array_sort(F.array_distinct(F.transform("_team", member)))  # not compiled, so most procedures, of one member, go without
    df = df.withColumn("_crew", F.when(F.size("_team") == 1, F.array(member(F.get("_team", F.lit(0))))).otherwise(several))
    df = privacy.ids(df, ("Procedure", "procedure_id"), _case=("Encounter", "case_id"), _unit=("OrgUnit", "unit"))
    unit = F.array(F.struct(to("Organization", "_unit").alias("actor"), F.lit(None).cast("struct<coding:array<struct<system:string,code:string>>>").alias("function")))
    subject = F.coalesce(F.col("_subject"), to("Encounter", "_case"))
    return emit(df, "Procedure", F.col("_id"), F.col("_pseudo"),
        status=F.when(_wrong(), "entered-in-error").otherwise("completed"), code=concept(OPS, F.col("code")), bodySite=some(concept(ISH + "tn26e", F.col("site"))), subject=subject, encounter=to("Encounter", "_case"), performedDateTime=privacy.moved(F.col("day").cast("string")), performer=F.concat(unit, F.coalesce("_crew", F.array().cast("array<struct<actor:struct<reference:string>,function:struct<coding:array<struct<system:string,code:string>>>>>"))))


#: Key of a lab document, shared by its header and its values.
DOC = ("doc_kind", "doc_number", "doc_version", "doc_part")


def lab_heads(heads: DataFrame, privacy: Privacy = CLEAR) -> DataFrame:
    """One header per document (of several, the least by patient, case, time and state) with what its patient becomes."""
    of = ("patient_id", "case_id", "ts", "status")
    one = heads.groupBy(*DOC).agg(F.min(F.struct(*of)).alias("_h")).select(*DOC, *[F.col(f"_h.{k}") for k in of])
    return privacy.people(one)


def lab_reports(heads: DataFrame, values: DataFrame, privacy: Privacy = CLEAR) -> DataFrame:
    """Lab headers with their case and references to their values; documents that only have values give no report."""
    each = privacy.ids(values.select(*DOC, "lab_id"), ("ObsLab",), _value=("ObsLab", *DOC, "lab_id"))
    result = each.groupBy(*DOC).agg(F.array_sort(F.collect_set(to("Observation", "_value"))).alias("_result"))
    df, when = lab_heads(heads, privacy).join(result, [*DOC], "left"), privacy.moved(_stamp("ts"))
    return emit(df, "DiagnosticReport", privacy.rid("LabReport", *DOC), F.col("_pseudo"),
        status=c.lookup(F.upper("status"), c.LAB_STATES, "final"), category=F.array(fixed(HL7 + "v2-0074", F.lit("LAB"))), code=F.struct(F.lit("Laborbefund").alias("text")), subject=F.col("_subject"), encounter=privacy.ref("Encounter", "Encounter", "case_id"), effectiveDateTime=when, issued=when, result=F.col("_result"))


def lab_values(v: DataFrame, heads: DataFrame, loinc: DataFrame, privacy: Privacy = CLEAR) -> DataFrame:
    """Values with report, patient and case of their document's header, local code (and LOINC where mapped), parsed quantity or text, range, interpretation.

    A value takes its own time, else its header's.  One without a header (or with a
    null in its key) has no patient and no case, and no date unless in clear, as
    nothing says by how much to move it; it names its report all the same.  Flags
    outside the list are told as text.
    """
    low, high, text = c.lab_range(F.col("normal"))
    # parsed below the join, once: inlined, the expressions would outgrow a generated method
    df = v.select(*DOC, "lab_id", "code", "name", "raw", "unit", "flag", "status", F.col("ts").alias("_own"), low.alias("_low"), high.alias("_high"), text.alias("_text"), c.lab_quantity(F.col("raw")).alias("_q"))
    known = privacy.ids(lab_heads(heads, privacy), ("LabReport", *DOC), _case=("Encounter", "case_id"))
    known = known.select(*DOC, F.col("ts").alias("_head"), "_case", "_pseudo", "_subject", *([] if privacy.clear else ["_days"]))
    df = df.join(loinc, "code", "left").join(known, [*DOC], "left").withColumn("_at", _stamp(F.coalesce("_own", "_head")))
    df = privacy.ids(df, ("ObsLab", *DOC, "lab_id"), _report=("LabReport", *DOC))
    low, high, text, q, own, flag = (F.col(k) for k in ("_low", "_high", "_text", "_q", "code", "flag"))
    code = some(F.when(F.col("loinc").isNotNull(), F.struct(F.lit(LOINC).alias("system"), F.col("loinc").alias("code"))), F.when(F.trim(own) != "", F.struct(F.lit(ISH + "leistid").alias("system"), own.alias("code"))))
    value = lambda x: F.when(x.isNotNull(), F.struct(x.alias("value")))
    bounds = F.when(low.isNotNull() | high.isNotNull() | text.isNotNull(), F.array(F.struct(value(low).alias("low"), value(high).alias("high"), text.alias("text"))))
    told = c.lookup(F.upper(F.trim(flag)), c.FLAGS)
    strange = F.when((F.trim(flag) != "") & told.isNull(), F.trim(flag))
    sense = F.when(strange.isNull(), fixed(HL7 + "v3-ObservationInterpretation", c.lab_interpret(flag, q, low, high))["coding"])
    raw = F.trim("raw")
    return emit(df, "Observation", F.col("_id"), F.col("_pseudo"),
        status=c.lookup(F.upper("status"), c.LAB_STATES, "final"), category=F.array(fixed(HL7 + "observation-category", F.lit("laboratory"))), code=F.struct(code.alias("coding"), F.coalesce(F.nullif(F.trim("name"), F.lit("")), own).alias("text")),
        partOf=some(to("DiagnosticReport", "_report")), subject=F.col("_subject"), encounter=to("Encounter", "_case"), effectiveDateTime=privacy.moved(F.col("_at")),
        valueQuantity=F.when(q.isNotNull(), F.struct(q.alias("value"), F.nullif(F.trim("unit"), F.lit("")).alias("unit"), c.lab_comparator(F.col("raw")).alias("comparator"))), valueString=F.when((raw != "") & q.isNull(), raw), referenceRange=bounds,
        interpretation=F.when(strange.isNotNull() | sense.isNotNull(), F.array(F.struct(sense.alias("coding"), strange.alias("text")))))


def documents(x: DataFrame, privacy: Privacy = CLEAR) -> DataFrame:
    """Document links: master id, type, author, date, error state."""
    pid = F.col("patient_id")
    return emit(x, "DocumentReference", privacy.rid("DocRef", "doc_id"), privacy.patient(pid), status=F.when(_wrong(), "entered-in-error").otherwise("current"), masterIdentifier=F.struct(F.lit(ISH + "dms-dokid").alias("system"), F.col("doc_id").cast("string").alias("value")), type=concept(ISH + "n2dt", F.col("doc_type")), subject=privacy.ref("Patient", "Patient", "patient_id"), date=privacy.date(pid, c.combine_datetime(F.col("day"), F.col("time"))), author=some(privacy.ref("Practitioner", "Practitioner", "author"), privacy.ref("Organization", "OrgUnit", "unit")))


def coverages(x: DataFrame, insurance: DataFrame, privacy: Privacy = CLEAR) -> DataFrame:
    """Payer of a case, self-payers marked, member number of the patient's insurance with the same payer (hashed unless clear)."""
    df = x.join(insurance, ["patient_id", "payer"], "left")
    member = F.col("member") if privacy.mode == "off" else c.hash_id(privacy.secret, F.col("member"), "kvnr")
    return emit(df, "Coverage", privacy.rid("Coverage", "coverage_id"), privacy.patient(F.col("patient_id")), status=F.when(_wrong(), "cancelled").otherwise("active"), beneficiary=privacy.ref("Encounter", "Encounter", "case_id"), payor=F.array(privacy.ref("Organization", "OrgPayer", "payer")), period=period(privacy.date(F.col("patient_id"), text_date(F.col("begin_date"))), privacy.date(F.col("patient_id"), text_date(F.col("end_date")))), type=F.struct(F.when(F.col("payer") == 0, "Selbstzahler").otherwise(F.col("kind")).alias("text")), subscriberId=member)


#: Birth measurements, LOINC codes and units.
BIRTH = (("weight", "Geburtsgewicht", "8339-4", "g"), ("length", "Geburtslaenge", "8305-5", "cm"), ("head", "Kopfumfang", "8287-5", "cm"))


def births(b: DataFrame, privacy: Privacy = CLEAR) -> DataFrame:
    """Up to three observations a birth; the patient comes from the case, so dates are shifted too."""
    items = F.array(*[F.struct(F.lit(t).alias("text"), F.lit(code).alias("loinc"), F.col(k).cast("double").alias("value"), F.lit(u).alias("unit")) for k, t, code, u in BIRTH])
    df = b.select("*", F.explode(items).alias("m")).where("m.value is not null and m.value <> 0")
    pid = F.col("patient_id")
    return emit(df, "Observation", privacy.rid("ObsBirth", "case_id", F.col("m.text")), privacy.patient(pid), status=F.lit("final"), code=F.struct(F.array(F.struct(F.lit(LOINC).alias("system"), F.col("m.loinc").alias("code"))).alias("coding"), F.col("m.text").alias("text")), encounter=privacy.ref("Encounter", "Encounter", "case_id"), effectiveDateTime=privacy.date(pid, F.col("day").cast("string")), valueQuantity=F.struct("m.value", "m.unit"))


def locations(x: DataFrame, privacy: Privacy = CLEAR) -> DataFrame:
    """Building elements with their parent and managing unit."""
    return emit(x, "Location", privacy.rid("Location", "location_id"), F.lit(None), status=F.lit("active"), name=F.col("name"), physicalType=F.coalesce(concept(ISH + "tn11b", F.col("kind")), F.lit(None)), partOf=privacy.ref("Location", "Location", "parent"), managingOrganization=privacy.ref("Organization", "OrgUnit", "unit"))


def medications(x: DataFrame, privacy: Privacy = CLEAR) -> DataFrame:
    """Orders: code system by whether the code is all digits, dose, quantity, substitution."""
    pid, drug = F.col("patient_id"), F.col("drug").cast("string")
    system = F.when(drug.rlike("^[0-9]+$"), "http://fhir.de/CodeSystem/ifa/pzn").otherwise(ISH + "drugid")
    return emit(x, "MedicationRequest", privacy.rid("MedReq", "order_id"), privacy.patient(pid), status=F.when(_wrong(), "entered-in-error").otherwise("active"), intent=F.lit("order"), medicationCodeableConcept=F.struct(F.array(F.struct(system.alias("system"), drug.alias("code"))).alias("coding"), F.col("text").alias("text")), subject=privacy.ref("Patient", "Patient", "patient_id"), encounter=privacy.ref("Encounter", "Encounter", "case_id"), authoredOn=privacy.date(pid, F.col("day").cast("string")), dosageInstruction=F.array(F.struct(F.col("dose").alias("text"))), dispenseRequest=F.struct(F.struct(F.col("quantity").alias("value")).alias("quantity")), substitution=F.struct((F.col("aut_idem") != "X").alias("allowedBoolean")))


def risks(x: DataFrame, privacy: Privacy = CLEAR) -> DataFrame:
    """Allergies as AllergyIntolerance with their category; infections and notices as Flag."""
    kind, pid = c.risk_class(F.col("code"), F.col("text")), F.col("patient_id")
    allergy = kind == "allergy"
    state = F.when(c.is_set(F.col("deleted")), "inactive").otherwise("active")
    when = privacy.date(pid, F.col("day").cast("string"))
    who = privacy.ref("Patient", "Patient", "patient_id")
    code = F.struct(F.array(F.struct(F.lit(ISH + "rsfnr").alias("system"), F.col("code"))).alias("coding"), privacy.text(F.col("text")).alias("text"))
    name, id_ = F.when(allergy, "AllergyIntolerance").otherwise("Flag"), F.when(allergy, privacy.rid("Allergy", "risk_id")).otherwise(privacy.rid("Flag", "risk_id"))
    one = F.to_json(F.struct(name.alias("resourceType"), id_.alias("id"), fixed(HL7 + "allergyintolerance-clinical", state).alias("clinicalStatus"), some(c.allergy_category(F.col("code"))).alias("category"), code.alias("code"), who.alias("patient"), when.alias("recordedDate")))
    safety = F.array(fixed(HL7 + "flag-category", F.when(kind == "infection", "safety").otherwise("admin")))
    other = F.to_json(F.struct(name.alias("resourceType"), id_.alias("id"), state.alias("status"), safety.alias("category"), code.alias("code"), who.alias("subject"), period(when, F.lit(None).cast("string")).alias("period")))
    return x.select(name.alias("resource_type"), id_.alias("id"), privacy.patient(pid).alias("patient"), F.when(allergy, one).otherwise(other).alias("body"))


def organizations(x: DataFrame, kind: str, type_code: str | None, system: str, privacy: Privacy = CLEAR, *, parent: Column | None = None) -> DataFrame:
    """Payers, units, facilities and clearing houses: id, name, identifiers, parent."""
    ik = F.when(c.code_concept(F.col("ik").cast("string")).isNotNull(), F.struct(F.lit("http://fhir.de/sid/arge-ik/iknr").alias("system"), F.col("ik").cast("string").alias("value")))
    own = F.struct(F.lit(system).alias("system"), F.col("org_id").cast("string").alias("value"))
    return emit(x, "Organization", privacy.rid(kind, "org_id"), F.lit(None), active=~c.is_set(F.col("deleted")), type=F.array(fixed(HL7 + "organization-type", F.lit(type_code))) if type_code else F.lit(None).cast("string"), name=F.nullif(F.trim("name"), F.lit("")), identifier=some(ik, own), partOf=parent if parent is not None else F.lit(None).cast("string"))


def practitioners(names: DataFrame, roles: DataFrame, privacy: Privacy = CLEAR) -> DataFrame:
    """Name part and role part of one person, from a full outer join; active only if both are."""
    df = names.withColumn("_n", F.lit(1)).join(roles.withColumn("_r", F.lit(1)), "person", "full")
    ids = some(F.when(F.col("_n") == 1, F.struct(F.lit(ISH + "gpart").alias("system"), F.col("person").cast("string").alias("value"))), F.when(F.col("_r") == 1, F.struct(F.lit(ISH + "pernr").alias("system"), F.col("person").cast("string").alias("value"))), F.when(c.code_concept(F.col("lanr")).isNotNull(), F.struct(F.lit("http://fhir.de/sid/kbv/lanr").alias("system"), F.col("lanr").alias("value"))))
    active = ~c.is_set(F.col("name_deleted")) & ~c.is_set(F.col("role_deleted"))
    return emit(df, "Practitioner", privacy.rid("Practitioner", "person"), F.lit(None), active=active, identifier=F.array_distinct(ids), name=F.when(F.col("name").isNotNull(), F.array(F.struct(F.col("name").alias("family")))) if privacy.mode == "off" else F.lit(None).cast("string"), qualification=some(concept(ISH + "tnkfa", F.col("specialty"))))


def accounts(groups: DataFrame, members: DataFrame, privacy: Privacy = CLEAR) -> DataFrame:
    """Billing groups with their leading case and reasons."""
    ext = members.groupBy("grp").agg(F.array_sort(F.collect_set(F.struct(F.when(c.is_set(F.col("lead")), ISH + "apx-lead-encounter").otherwise(ISH + "apx-reason").alias("url"), F.when(c.is_set(F.col("lead")), privacy.ref("Encounter", "Encounter", "case_id")).alias("valueReference"), F.when(~c.is_set(F.col("lead")), F.col("reason")).alias("valueString")))).alias("_ext"))
    df = groups.join(ext, "grp", "left")
    return emit(df, "Account", privacy.rid("Account", "grp"), privacy.patient(F.col("patient_id")), status=F.when(c.is_cancelled(F.col("group_cancelled")), "entered-in-error").otherwise("active"), type=fixed(HL7 + "v3-ActCode", F.lit("PBILLACCT")), identifier=F.array(F.struct(F.lit(ISH + "apxnr").alias("system"), F.col("grp").cast("string").alias("value"))), subject=F.array(privacy.ref("Patient", "Patient", "patient_id")), extension=F.col("_ext"))


def orders(x: DataFrame, privacy: Privacy = CLEAR) -> DataFrame:
    """Clinical orders; requested by a person, else by a unit; notes de-identified."""
    pid = F.col("patient_id")
    note = privacy.text(F.nullif(F.trim("note"), F.lit("")))
    return emit(x, "ServiceRequest", privacy.rid("ServiceRequest", "order_id"), privacy.patient(pid), status=F.when(_wrong(), "revoked").otherwise("active"), intent=F.lit("order"), code=F.struct(F.col("title").alias("text")), subject=privacy.ref("Patient", "Patient", "patient_id"), requester=F.coalesce(privacy.ref("Practitioner", "Practitioner", "person"), privacy.ref("Organization", "OrgUnit", "unit")), authoredOn=privacy.date(pid, F.col("day").cast("string")), note=F.when(note.isNotNull(), F.array(F.struct(note.alias("text")))))
