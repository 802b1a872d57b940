"""Alias lookup in free-form job records, used inside Arrow functions.

Key order matters here and VARIANT sorts keys, so the lookups run on the parsed text. They only
bring a record's many spellings to one set of names and types; dates, money, URLs and texts are Columns.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from typing import Any

# Spellings of each field, in the order they are tried.
ALIASES = {
    "id": (
        "id", "jobid", "job_id", "jobId", "uuid", "lowongan_id", "lowonganId", "id_lowongan", "idLowongan",
    ),
    "title": (
        "title", "job_title", "jobTitle", "name", "position", "judul", "nama_lowongan", "namaPekerjaan", "posisi",
    ),
    "posted": (
        "posted_at", "postedAt", "published_at", "publishedAt", "publish_at", "publishAt", "created_at", "createdAt",
        "updated_at", "updatedAt", "date_posted", "datePosted", "job_date", "jobDate", "tanggal_posting",
        "tanggal_publikasi", "diposting_pada", "dipublikasikan_pada",
    ),
    "slug": ("slug", "path", "permalink"),
    "link": ("url", "job_url", "detail_url", "link", "tautan", "tautan_lowongan", "url_lowongan"),
    "link_id": ("id", "jobid", "job_id", "uuid"),
    "place": ("location", "job_location", "location_name", "lokasi", "lokasi_kerja", "kota", "provinsi"),
    "kind": (
        "job_type", "employment_type", "employmentType", "type", "jobType", "jenis_pekerjaan", "tipe_pekerjaan",
    ),
    "kind_label": ("job_type_label", "employment_type_label"),
    "pay": ("salary", "salary_text", "salary_display", "salary_range", "gaji", "gaji_text", "salaryInfo"),
    "pay_min": ("salary_min", "salary_from", "min_salary", "minSalary"),
    "pay_max": ("salary_max", "salary_to", "max_salary", "maxSalary"),
    "currency": ("salary_currency", "currency", "salaryCurrency"),
}
COMPANY = (
    "company", "company_name", "companyName", "nama_perusahaan", "namaPerusahaan", "perusahaan", "employer_name",
    "employerName", "employer", "organization", "organization_name", "organizationName", "organisasi",
)
COMPANY_NAME = ("name", "company_name", "title", "label")
SHORT_ID = ("id", "jobid", "job_id", "uuid")
SHORT_TITLE = ("title", "job_title", "name", "position")
REMOTE = (
    "work_arrangement", "workArrangement", "work_location", "is_remote", "remote", "kerja_remote", "wfh",
    "work_from_home",
)
TAGS = ("job_skills", "skills", "tags", "keywords", "keahlian", "skill", "kata_kunci")
BODY = (
    "description", "job_description", "description_text", "full_description", "deskripsi", "deskripsi_pekerjaan",
    "keterangan",
)
AREAS = ("city", "district", "province", "country")
RECORD_LISTS = ("jobs", "data", "items", "results", "list")
META = ("current_page", "last_page", "total", "links", "next_page_url", "prev_page_url")


def walk(node: Any) -> Iterator[Any]:
    """The node and everything below it, parents first, in written order."""
    stack = [node]
    while stack:
        top = stack.pop()
        yield top
        if isinstance(top, dict):
            stack.extend(reversed(top.values()))
        elif isinstance(top, list):
            stack.extend(reversed(top))


def objects(node: Any) -> list[dict]:
    return [n for n in walk(node) if isinstance(n, dict)]


def find(nodes: list[dict], names: Sequence[str]) -> Any:
    """First value that is neither NULL nor '' under any of the names."""
    for node in nodes:
        for name in names:
            value = node.get(name)
            if value is not None and value != "":
                return value
    return None


def text(value: Any) -> str | None:
    return (value.strip() or None) if isinstance(value, str) else None


def named(value: Any, names: Sequence[str]) -> str | None:
    """Text of a value, or of an object's first filled key."""
    if isinstance(value, dict):
        value = next(filter(None, map(value.get, names)), None)
    return text(value)


def company(nodes: list[dict]) -> str | None:
    value = find(nodes, COMPANY)
    return named(value, COMPANY_NAME) or text(find(objects(value), COMPANY_NAME))


def job_like(node: dict) -> bool:
    nodes = objects(node)
    return find(nodes, SHORT_ID) is not None and find(nodes, SHORT_TITLE) is not None and company(nodes) is not None


def whole(value: Any) -> int | None:
    """Integer, integral float or numeric text as a 64-bit number; not boolean."""
    if isinstance(value, bool) or (isinstance(value, float) and not value.is_integer()):
        return None
    try:
        number = int(value)
    except (TypeError, ValueError):
        return None
    return number if -(2**63) <= number < 2**63 else None


def label(value: Any) -> str | None:
    """Any value but a boolean as text; integral floats lose their fraction."""
    if value is None or isinstance(value, bool):
        return None
    return text(str(int(value) if isinstance(value, float) and value.is_integer() else value))


def posted(value: Any) -> tuple[float | None, str | None]:
    """Epoch number (numeric text included), or else text."""
    written = label(value)
    if isinstance(value, (int, float)) and written is not None:
        return float(value), None
    number = whole(written)
    return (None, written) if number is None else (float(number), None)


def canonical(record: dict, alt: bool = False) -> dict:
    """The record under one set of field names and types."""
    nodes = objects(record)
    found = {field: find(nodes, keys) for field, keys in ALIASES.items()}
    flags = [find(nodes, (key,)) for key in REMOTE]
    lists = [find(nodes, (key,)) for key in TAGS]
    bodies = (text(find(nodes, (key,))) for key in BODY)
    areas = [named(record.get(key), ("name", "label")) for key in AREAS]
    number, written = posted(found["posted"])
    return {
        **{field: text(found[field]) for field in ("title", "slug", "link", "place", "kind", "kind_label", "pay", "currency")},
        "id": label(found["id"]),
        "link_id": label(found["link_id"]),
        "company": company(nodes),
        "posted": written,
        "posted_number": number,
        "low": whole(found["pay_min"]),
        "high": whole(found["pay_max"]),
        "remote": any(f is True or (isinstance(f, str) and f.lower() == "remote") for f in flags),
        "tags": [t for items in lists if isinstance(items, list) for i in items if (t := named(i, ("name", "label", "title")))],
        "areas": [a for a in areas if a],
        "body": next(filter(None, bodies), None),
        "alt": alt,
    }


def _records_at(node: Any) -> list | None:
    if isinstance(node, list):
        return node if node and all(isinstance(i, dict) for i in node) else None
    if not isinstance(node, dict):
        return None
    state = node.get("state")
    loaders = state.get("loaderData") if isinstance(state, dict) else None
    for route in loaders.values() if isinstance(loaders, dict) else ():
        if isinstance(route, dict) and isinstance(route.get("jobs"), list) and route["jobs"]:
            return route["jobs"]
    for key in RECORD_LISTS:
        listed = node.get(key)
        kept = [i for i in listed if isinstance(i, dict)] if isinstance(listed, list) else []
        if kept:
            return kept
    return None


def job_records(payload: Any) -> list[dict] | None:
    """The first list of records anywhere in the payload."""
    hits = (r for node in walk(payload) if (r := _records_at(node)) is not None)
    found = next(hits, None)
    return None if found is None else [r for r in found if isinstance(r, dict)]


def page_meta(node: Any) -> dict:
    """Pagination facts: the first object with any of the keys; a ``meta`` object is looked into alone."""
    if isinstance(node, dict):
        facts = {key: node[key] for key in META if key in node}
        if facts:
            return facts
        below = [node["meta"]] if isinstance(node.get("meta"), dict) else node.values()
    else:
        below = node if isinstance(node, list) else ()
    return next(filter(None, map(page_meta, below)), {})


def first_object(candidates: list[str]) -> dict | None:
    """First candidate text that is one whole JSON object."""
    for candidate in candidates:
        try:
            parsed = json.loads(candidate)
        except ValueError:
            continue
        if isinstance(parsed, dict):
            return parsed
    return None


def listing_records(context: dict | None) -> list[dict]:
    """Canonical records; one that does not look like a job is followed by its first job-like part."""
    out = []
    for record in job_records(context) or []:
        out.append(canonical(record))
        if not job_like(record):
            inner = next((n for n in objects(record)[1:] if job_like(n)), None)
            out.extend([] if inner is None else [canonical(inner, alt=True)])
    return out


def detail_record(context: dict | None) -> dict | None:
    """The job a detail page is about: the first job-like record of its list, else the first such object."""
    listed = next(filter(job_like, job_records(context) or []), None)
    if listed is None:
        listed = next(filter(job_like, objects(context)), None)
    return None if listed is None else canonical(listed)
