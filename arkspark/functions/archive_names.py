"""What the names of archive files tell about their crawl.

A layout is a pattern over the name, a check of its dates, a score and the fields it fills. All are column expressions:
``archive_name`` gives, for a column of names, the reading with the best score. Values that are used more than once are
bound to a lambda variable, so that the expressions stay small. Names repeat over the records of a file,
so that it pays to read distinct names and join the readings back (``operators.archive_files.with_archive_names``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from arkspark.functions.scalars import bind

#: The fields of a reading, in their order, and their types.
FIELDS = (
    ("crawl_identifier", "string"), ("crawl_original_identifier", "string"), ("crawl_provider", "string"), ("crawl_collection_id", "string"), ("crawl_generation_code", "string"), ("crawl_sequence", "int"), ("crawl_run", "int"), ("crawl_job_id", "string"), ("crawl_seed_id", "string"), ("crawl_token", "string"),
    ("crawl_interval", "string"), ("crawl_depth", "string"), ("crawl_tuning_parameter", "int"), ("crawl_subset", "string"), ("crawl_flags", "array<string>"),
    ("crawler_name", "string"), ("crawler_hostname", "string"), ("crawler_hostname_internal", "string"), ("crawler_ip_address", "string"), ("crawler_ip_address_internal", "string"), ("crawler_mac_address", "string"), ("crawler_pid", "string"), ("crawler_node", "string"),
    ("crawl_start_date", "string"), ("crawl_year", "string"), ("crawl_batch_start", "string"), ("file_write_start", "string"), ("file_write_end", "string"), ("crawl_processing", "string"),
    ("file_serial_number", "string"), ("file_partition", "string"), ("file_segment", "string"), ("file_segment_time", "string"),
)
PACIFIC = "America/Los_Angeles"

# Tags, identifiers and crawlers of the layouts.
TAGS_1996 = {"FS": "firestone", "GR": "green", "ST": "sterling", "TS": None, "F2": None, "IA": "widener", "BK": "berkeley", "IA-E96": "widener"}
IDENTIFIERS_1998 = ("green", "slash", "sarah", "to", "title_crawl", "to-crawl", "robots", "20000706", "20000710", "amazon", "foo")
#: Of an identifier: its crawler before and from the given stamp.
CRAWLERS_1998 = {"green": ("green", "crawl1"), "title": ("green", "crawl1"), "to": ("green", "crawl1"), "to-crawl": ("green", "crawl1"), "slash": ("green", "crawl1"), "robots": ("green", "crawl1"), "sarah": ("sarah", "crawl2")}
CRAWLERS_1998_CHANGE = "20000229080000"
SUBSETS_2001 = ("images", "binary", "binary1", "dad", "amzn")
CRAWLERS_COMPAQ = {"aug": "crawler0", "image": "crawler1"}
#: From this stamp on, crawlers' hosts are in the "us" part of the domain.
US_HOSTS_FROM = "20060615000000"


def _group(text: Column, pattern: str, number: int) -> Column:
    """A group of the pattern; null if it is empty or nothing matches."""
    return F.nullif(F.regexp_extract(text, pattern, number), F.lit(""))


def _groups(text: Column, pattern: str, count: int, use: Callable[..., Column]) -> Column:
    """``use`` of the pattern's first ``count`` groups; null where it isn't found, which is told by one search."""
    taken = F.struct(*(_group(text, pattern, i).alias(f"g{i}") for i in range(1, count + 1)))
    return F.when(text.rlike(pattern), bind(taken, lambda g: use(*(g[f"g{i}"] for i in range(1, count + 1)))))


def without_extensions(file: Column) -> Column:
    for extension in ("gz", "zst", "arc", "warc"):
        file = F.regexp_replace(file, rf"(?i)\.{extension}$", "")
    return file


def record_format(name: Column) -> Column:
    """"warc" or "arc", compressed or not; null for any other extension."""
    return F.lower(_group(name, r"(?i)\.(warc|arc)(?:\.zst)?(?:\.gz)?$", 1))


def _moment(digits: Column, length: int = 14) -> Column:
    """Time without zone of yyyyMMddHHmmss, a stamp of 17 digits without its milliseconds; null if there is no such time."""
    parts = (F.substring(digits, at, n) for at, n in ((1, 4), (5, 2), (7, 2), (9, 2), (11, 2), (13, 2)))
    marks = (F.lit(x) for x in ("-", "-", " ", ":", ":"))
    text = F.concat(next(parts), *(x for mark in marks for x in (mark, next(parts))))
    return F.when(digits.rlike(rf"^\d{{{length}}}$"), text.try_cast("timestamp_ntz"))


def _utc(local: Column) -> Column:
    return F.convert_timezone(F.lit(PACIFIC), F.lit("UTC"), local)


def _iso(moment: Column) -> Column:
    return F.concat(F.replace(moment.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))


def _iso17(digits: Column) -> Column:
    """ISO time of a stamp of 17 digits, with its milliseconds; null if invalid."""
    return F.concat(F.replace(_moment(digits, 17).cast("string"), F.lit(" "), F.lit("T")), F.lit("."), F.substring(digits, 15, 3), F.lit("Z"))


def _after_epoch(seconds: Column) -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def _epoch(seconds: Column) -> Column:
    """Time of epoch seconds, which never start with a zero."""
    return _after_epoch(F.when(seconds.rlike(r"^[1-9]\d{0,9}$"), seconds.try_cast("long")))


def _iso_millis(millis: Column) -> Column:
    n = F.when(millis.rlike(r"^\d{1,13}$"), millis.try_cast("long"))
    return bind(n, lambda n: F.concat(F.replace(_after_epoch(F.floor(n / 1000)).cast("string"), F.lit(" "), F.lit("T")), F.lit("."), F.lpad((n % 1000).cast("string"), 3, "0"), F.lit("Z")))


def _date(digits: Column) -> Column:
    """yyyy-MM-dd of eight digits; null if there is no such day."""
    return F.when(digits.rlike(r"^\d{8}$"), F.concat_ws("-", F.substring(digits, 1, 4), F.substring(digits, 5, 2), F.substring(digits, 7, 2)).try_cast("date").cast("string"))


def _years(moment: Column, first: int, last: int = 9999) -> Column:
    return F.year(moment).between(first, last)


def _value_of(column: Column, table: dict[str, str | None]) -> Column:
    return F.element_at(F.create_map(*(F.lit(x).cast("string") for pair in table.items() for x in pair)), column)


def crawler_parts(name: Column) -> Column:
    """A struct of a crawler's name taken apart: pid~host~port, host-port, an internal host with its IP or MAC address in
    it, a host of a domain, or a plain name."""
    tilde = r"^([^~]*)~([^~]*)~([^~]*)$"
    ip, mac = r"(?i)^ip-(\d+)-(\d+)-(\d+)-(\d+)\.ec2\.internal$", r"(?i)^domU-((?:[0-9a-f]{2}-){5}[0-9a-f]{2})\.compute-\d+\.internal$"
    host = F.when(name.rlike(tilde), F.regexp_replace(name, tilde, "$2:$3")).otherwise(F.regexp_replace(name, r"-(\d+)$", ":$1"))
    split = F.struct(host.alias("host"), F.substring_index(host, ":", 1).alias("only"), _group(name, tilde, 1).alias("pid"))

    def told(s: Column) -> Column:
        internal, domain = s["only"].rlike(r"(?i)\.internal$"), s["only"].rlike(r"(?i)\.[a-z]+$")
        return F.struct(
            F.when(~domain, s["host"]).alias("crawler_name"), F.when(domain & ~internal, s["host"]).alias("crawler_hostname"), F.when(internal, s["host"]).alias("crawler_hostname_internal"),
            F.when(s["only"].rlike(ip), F.regexp_replace(s["only"], ip, "$1.$2.$3.$4")).alias("crawler_ip_address_internal"),
            F.upper(F.replace(_group(s["only"], mac, 1), F.lit("-"), F.lit(":"))).alias("crawler_mac_address"), s["pid"].alias("crawler_pid"),
        )

    return bind(split, told)


_CRAWLER_FIELDS = ("crawler_name", "crawler_hostname", "crawler_hostname_internal", "crawler_ip_address_internal", "crawler_mac_address", "crawler_pid")


def archive_host(crawler: Column, stamp: Column) -> Column:
    """The host of a crawler at a time, whose text is compared as it is."""
    return F.concat(crawler, F.when(stamp >= US_HOSTS_FROM, F.lit(".us")).otherwise(F.lit("")), F.lit(".archive.org"))


class Name:
    """A file name with path (full), its last part (file), that without extensions (base), the record format, null if
    unknown, and the stamp of a capture in the file."""

    def __init__(self, parts: Column, generic: Column | None = None):
        self.full, self.file, self.base, self.format, self.stamp = (parts[k] for k in ("full", "file", "base", "format", "stamp"))
        self.arc, self.warc = self.format == "arc", self.format == "warc"
        #: The generic reading of the name, for layouts that build on it.
        self.generic = generic

    @staticmethod
    def parts(name: Column, stamp: Column) -> Column:
        file = F.substring_index(name, "/", -1)
        return F.struct(name.alias("full"), file.alias("file"), without_extensions(file).alias("base"), record_format(name).alias("format"), stamp.alias("stamp"))

    def within(self, low: str | None, high: str | None = None, open_end: bool = False) -> Column:
        """Whether the capture's stamp lies in a window; false without a stamp."""
        inside = F.lit(True)
        if low:
            inside = inside & (self.stamp >= low)
        if high:
            inside = inside & ((self.stamp < high) if open_end else (self.stamp <= high))
        return F.coalesce(inside, F.lit(False))


def _reading(label: str, fits: Column, score: Column, fields: dict[str, Column | str], kind: Column | str) -> Column:
    """(confidence, layout, record_format, details), null where the name doesn't fit."""
    value = lambda x: F.lit(x) if x is None or isinstance(x, str | int) else x
    details = F.struct(*(value(fields.get(name)).cast(type_).alias(name) for name, type_ in FIELDS))
    return F.when(fits, F.struct(score.cast("double").alias("confidence"), F.lit(label).alias("layout"), value(kind).cast("string").alias("record_format"), details.alias("details")))


def _scored(inside: Column) -> Column:
    return F.when(inside, F.lit(1.0)).otherwise(F.lit(0.8))


def _more(held: Column, by: float = 0.1) -> Column:
    return F.when(held, F.lit(by)).otherwise(F.lit(0.0))


def _tagged_1996(n: Name) -> Column:
    def read(tag: Column, serial: Column) -> Column:
        score = F.lit(0.5) + _more(tag.isin(*TAGS_1996), 0.25) + _more(n.within(None, "19980801235959"), 0.25)
        return _reading("alexa-1996", tag.isNotNull(), score, {"crawl_identifier": tag, "file_serial_number": serial, "crawler_name": _value_of(tag, TAGS_1996), "crawl_provider": "alexa"}, "arc")

    return _groups(n.file, r"^([A-Z]{2}(?=-\d{6}[A-Z]?\.)|F2(?=-\d{6}[A-Z]?\.)|IA-E96(?=-\d{2}\.))-(\d+[A-Z]?)\.arc\.gz$", 2, read)


def _dashed_1998(n: Name) -> Column:
    """From the right: epoch, local stamp, date and serial number, the last three optional; what is left is the identifier."""
    pattern = r"^(.*?)(?:(?:^|-)(\d{14}))?-([1-9]\d*)$"

    def whole(rest: Column, stamp: Column, seconds: Column) -> Column:
        stamped = F.coalesce(_years(_moment(stamp), 1998, 2000), F.lit(False))
        held = F.struct(F.when(stamped, rest).otherwise(F.concat_ws("-", rest, stamp)).alias("rest"), F.when(stamped, _moment(stamp)).alias("batch"), _epoch(seconds).alias("written"))
        return bind(held, dated)

    def dated(h: Column) -> Column:
        last = F.substring_index(h["rest"], "-", -1)
        is_day = F.coalesce(F.substring(_date(last), 1, 4).isin("1998", "1999", "2000"), F.lit(False))
        return bind(is_day, lambda day: bind(F.struct(F.when(day, _without_last(h["rest"])).otherwise(h["rest"]).alias("rest"), F.when(day, _date(last)).alias("date")), lambda d: numbered(h, d)))

    def numbered(h: Column, d: Column) -> Column:
        serial = _group(d["rest"], r"(?:^|-)(\d{4,})$", 1)
        return bind(serial, lambda serial: bind(F.when(serial.isNotNull(), _without_last(d["rest"])).otherwise(d["rest"]), lambda rest: named(h, d["date"], serial, rest)))

    def named(h: Column, date: Column, serial: Column, rest: Column) -> Column:
        tail = _moment(_group(rest, r"_(\d{14})$", 1))
        return bind(F.when(_years(tail, 1998, 2000), tail), lambda tail: bind(F.when(tail.isNotNull(), F.regexp_replace(rest, r"_\d{14}$", "")).otherwise(rest), lambda identifier: filled(h, date, serial, rest, tail, identifier)))

    def filled(h: Column, date: Column, serial: Column, rest: Column, tail: Column, identifier: Column) -> Column:
        score = F.lit(0.6) + _more(h["batch"].isNotNull()) + _more(date.isNotNull()) + _more(serial.isNotNull()) + _more(tail.isNotNull()) + _more(n.within("19980701000000", "20000801235959"), 0.2)
        own_date = F.when(F.substring(_date(rest), 1, 4).isin("1998", "1999", "2000"), _date(rest))
        changed = F.date_format(h["written"], "yyyyMMddHHmmss") >= CRAWLERS_1998_CHANGE
        before, after = (_value_of(identifier, {k: v[i] for k, v in CRAWLERS_1998.items()}) for i in (0, 1))
        fields = {
            "crawl_identifier": identifier, "crawl_provider": "alexa", "crawl_start_date": F.coalesce(date, own_date), "crawl_batch_start": _iso(_utc(F.coalesce(tail, h["batch"]))),
            "file_write_start": _iso(h["written"]), "file_serial_number": serial, "crawler_name": F.when(changed, after).otherwise(before),
        }
        return _reading("alexa-1998", n.arc & _years(h["written"], 1998, 2000) & identifier.isin(*IDENTIFIERS_1998), score, fields, "arc")

    return _groups(n.base, pattern, 3, whole)


def _without_last(parts: Column) -> Column:
    return F.regexp_replace(parts, r"(^|-)[^-]*$", "")


def _images_2000_04(n: Name) -> Column:
    def read(identifier: Column, prefix: Column, node: Column, third: Column, seconds: Column) -> Column:
        tuning = _group(third, r"^\s*([+-]?\d+)", 1).try_cast("int")
        serial, written = F.when(tuning.isNull(), third), _epoch(seconds)
        fits = n.arc & _years(written, 2000, 2000) & F.when(prefix == "crc", serial.isNotNull()).otherwise(tuning.isNotNull())
        fields = {"crawl_identifier": identifier, "crawl_provider": "alexa", "crawler_name": F.when(prefix == "crc", identifier), "file_write_start": _iso(written), "file_serial_number": serial, "crawl_tuning_parameter": tuning, "crawler_node": node}
        return _reading("alexa-2000-04-image", fits, _scored(n.within("20000422000000", "20000619000000")), fields, "arc")

    return _groups(n.base, r"^((test|short|crc)(?:\d[^-]*)?)-([^-]*)-([^-]*)-([1-9]\d*)$", 5, read)


def _recy_2000_06(n: Name) -> Column:
    def read(identifier: Column, serial: Column, seconds: Column) -> Column:
        fields = {"crawl_identifier": identifier, "crawl_provider": "alexa", "crawl_start_date": "2000-06-02", "file_write_start": _iso(_epoch(seconds)), "file_serial_number": serial}
        return _reading("alexa-2000-06-recy-crawl", _years(_epoch(seconds), 2000, 2000), _scored(n.within("20000601000000", "20000621000000")), fields, "arc")

    return _groups(n.file, r"^(Recy20000602)([a-z]{2})-(\d{9})\.arc\.gz$", 3, read)


def _images_2000_07(n: Name) -> Column:
    def read(identifier: Column, generation: Column, serial: Column, seconds: Column) -> Column:
        fields = {"crawl_identifier": identifier, "crawl_provider": "alexa", "crawl_generation_code": generation, "file_write_start": _iso(_epoch(seconds)), "file_serial_number": serial}
        return _reading("alexa-2000-07-image", n.arc & _years(_epoch(seconds), 2000, 2000), _scored(n.within("20000701000000", "20001015000000")), fields, "arc")

    return _groups(n.base, r"^(IMG_(A[A-Za-z]{2}))_SUB([a-z]{2}(?:_\d+)?)-(\d{9})$", 4, read)


def _dated_2000_07(n: Name) -> Column:
    def read(identifier: Column, serial: Column, stamp: Column, seconds: Column) -> Column:
        fields = {"crawl_identifier": identifier, "crawl_provider": "alexa", "crawl_start_date": _date(identifier), "crawl_batch_start": _iso(_utc(_moment(stamp))), "file_write_start": _iso(_epoch(seconds)), "file_serial_number": serial}
        return _reading("alexa-2000-07", n.arc & _years(_epoch(seconds), 2000, 2000) & _years(_moment(stamp), 2000, 2000), _scored(n.within("20000701000000", "20001104000000")), fields, "arc")

    return _groups(n.base, r"^(2000[^-.]{4})\.(\d{6})(?:\.[^-]*)?-(\d{14})-([1-9]\d*)$", 4, read)


def _dotted_2000_11(n: Name) -> Column:
    def read(identifier: Column, stamp: Column) -> Column:
        fields = {"crawl_identifier": identifier, "crawl_provider": "alexa", "file_write_start": _iso(_moment(stamp)), "crawler_name": identifier}
        return _reading("alexa-2000-11", n.arc & _years(_moment(stamp), 2000, 2001), _scored(n.within("20001101000000", "20010205000000")), fields, "arc")

    return _groups(n.base, r"^((?:crc|arc)\d+)\.(\d{14})(?:\..*)?$", 2, read)


def _underscored_2001(n: Name) -> Column:
    def read(identifier: Column, crawler: Column, stamp: Column) -> Column:
        subset = F.substring_index(identifier, "_", -1)
        fields = {
            "crawl_identifier": identifier, "crawl_provider": "alexa", "crawl_generation_code": _group(F.substring_index(identifier, "_", 1), r"^([DE][A-Z]\d*)$", 1),
            "crawl_subset": F.when(subset.isin(*SUBSETS_2001), subset), "file_write_start": _iso(_moment(stamp)), "crawler_name": crawler,
        }
        return _reading("alexa-2001-05", n.arc & _years(_moment(stamp), 2001, 2005), _scored(n.within("20010201000000", "20050830000000")), fields, "arc")

    return _groups(n.base, r"^(?!E02(?:_|$))([^.]*)_((?:arc|crc|crawl|alexa)\d+)\.(\d{14})(?:\..*)?$", 3, read)


def _election_2002(n: Name) -> Column:
    def read(interval: Column, serial: Column, crawler: Column, stamp: Column) -> Column:
        fields = {"crawl_identifier": F.concat(F.lit("E02_"), interval), "crawl_provider": "alexa", "crawl_interval": interval, "file_serial_number": serial, "file_write_start": _iso(_moment(stamp)), "crawler_name": crawler}
        return _reading("alexa-2002-election", n.arc & _years(_moment(stamp), 2001, 2005), _scored(n.within("20010201000000", "20050830000000")), fields, "arc")

    return _groups(n.base, r"^E02_([^_.]+)(?:_([^_.]*))?(?:_[^.]*)?_((?:arc|crc|crawl|alexa)\d+)\.(\d{14})(?:\..*)?$", 4, read)


def _sequence_2005(n: Name) -> Column:
    def read(head: Column, generation: Column, rest: Column, sequence: Column, crawler: Column, stamp: Column) -> Column:
        subset = F.substring_index(rest, "_", -1)
        fields = {
            "crawl_identifier": F.concat(head, F.lit("_"), sequence, F.lit("_0")), "crawl_provider": "alexa", "crawl_generation_code": generation, "crawl_sequence": sequence.try_cast("int"), "crawl_run": 0,
            "crawl_subset": F.when(subset != generation, subset), "file_write_start": _iso(_moment(stamp)), "crawler_name": crawler,
        }
        return _reading("alexa-2005-08", n.arc & _years(_moment(stamp), 2005, 2006), _scored(n.within("20050801000000", "20060701000000")), fields, "arc")

    return _groups(n.base, r"^((E[A-Z]\d*)(?:_([^.]+))?)_(\d+)_0_(crawl\d+)_\.(\d{14})(?:\..*)?$", 6, read)


def _sequence_2006(n: Name) -> Column:
    def read(sequence: Column, run: Column, stamp: Column, crawler: Column, subset: Column) -> Column:
        fields = {
            "crawl_identifier": F.concat_ws("_", sequence, run, subset), "crawl_provider": "alexa", "crawl_sequence": sequence.try_cast("int"), "crawl_run": run.try_cast("int"), "crawl_subset": subset,
            "crawl_start_date": _date(_group(F.substring_index(n.full, "/", 1), r"^alexa(\d{8})-\d{2}$", 1)), "file_write_start": _iso(_moment(stamp)), "crawler_name": crawler,
        }
        return _reading("alexa-2005-08", n.arc & _years(_moment(stamp), 2006, 2020), _scored(n.within("20060601000000", "20200901000000")), fields, "arc")

    return _groups(n.base, r"^(\d+)_(\d+)_(\d{14})_(crawl\d+)(?:_(IndexOnly))?$", 5, read)


def _compaq_regular(n: Name) -> Column:
    def read(identifier: Column, digits: Column) -> Column:
        written = _utc(_moment(F.concat(F.lit("20"), digits)))
        fields = {"crawl_identifier": identifier, "crawl_provider": "compaq-src", "crawler_name": _value_of(identifier, CRAWLERS_COMPAQ), "file_write_start": _iso(written)}
        return _reading("compaqsrc-regular", n.arc & written.isNotNull(), _scored(n.within("20000814000000", "20001013000000")), fields, n.format)

    return _groups(n.base, r"^(aug|image)-(\d{12})$", 2, read)


def _compaq_image(n: Name) -> Column:
    def read(generation: Column, digits: Column) -> Column:
        written = _utc(_moment(F.concat(F.lit("20"), digits)))
        fields = {"crawl_identifier": F.concat(F.lit("IMG_"), generation), "crawl_provider": "compaq-src", "crawl_generation_code": generation, "file_write_start": _iso(written)}
        return _reading("compaqsrc-image", n.arc & _years(written, 2000, 2000), _scored(n.within("20000701000000", "20001015000000")), fields, n.format)

    return _groups(n.base, r"^IMG_(X[A-Za-z]{2})_(\d{12})$", 2, read)


def _compaq_election(n: Name) -> Column:
    def read(stamp: Column) -> Column:
        fields = {"crawl_identifier": "unique", "crawl_provider": "compaq-src", "crawl_processing": _iso(_moment(stamp))}
        return _reading("compaqsrc-election2000", n.arc & _years(_moment(stamp), 2001, 2001), _scored(n.within("20000701000000", "20010701000000")), fields, n.format)

    return _groups(n.base, r"^unique\.(\d{14})$", 1, read)


def _segments(n: Name, label: str, pattern: str, count: int, more: Callable[..., dict[str, Column]]) -> Column:
    """Names in crawl-data/collection/segments/segment/subset/."""

    def read(*parts: Column) -> Column:
        def filled(collection: Column, time: Column, partition: Column, subset: Column) -> Column:
            fields = {
                "crawl_identifier": collection, "crawl_provider": "commoncrawl", "crawl_collection_id": collection, "file_partition": partition, "crawl_subset": subset,
                "file_segment": F.concat_ws(".", time, partition), "file_segment_time": _iso_millis(time), "file_write_start": _iso(_moment(parts[0])),
            }
            own = more(*parts[1:])
            return _reading(label, n.format.isNotNull() & n.full.startswith("crawl-data/CC-MAIN-") & collection.isNotNull() & _moment(parts[0]).isNotNull() & own.pop("fits", F.lit(True)), F.lit(1.0), fields | own, n.format)

        return _groups(n.full, r"crawl-data/(.*?)/segments/([^./]*)(?:\.([^./]*)[^/]*)?/(.*?)/", 4, filled)

    return _groups(n.base, pattern, count, read)


def _segments_2017(n: Name) -> Column:
    more = lambda end, serial: {"file_write_end": _iso(_moment(end)), "file_serial_number": serial, "fits": _moment(end).isNotNull()}
    return _segments(n, "commoncrawl-2017", r"^CC-MAIN-(\d{14})-(\d{14})-(?:.*-)?([^-]+)$", 3, more)


def _segments_2013(n: Name) -> Column:
    return _segments(n, "commoncrawl-2013", r"^CC-MAIN-(\d{14})-([^-]{5})(?:-(.*))?$", 3, lambda serial, crawler: {"file_serial_number": serial, "crawler_name": crawler, "fits": serial.isNotNull()})


def _segments_2012(n: Name) -> Column:
    def read(segment: Column, written: Column, partition: Column) -> Column:
        fields = {
            "crawl_identifier": "CC-MAIN-2012", "crawl_provider": "commoncrawl", "crawl_collection_id": "CC-MAIN-2012", "file_write_start": _iso_millis(written), "file_partition": partition,
            "file_segment": segment, "file_segment_time": _iso_millis(segment),
        }
        return _reading("commoncrawl-2012", segment.isNotNull(), F.lit(1.0), fields, "arc")

    return _groups(n.full, r"^parse-output(?:|.*?[^/]?)/segment/(\d+)/(\d+)_(\d+)\.arc\.gz", 3, read)


def _numbered_2008(n: Name) -> Column:
    def read(number: Column, year: Column, month: Column, day: Column, hour: Column, written: Column, partition: Column) -> Column:
        first = number == "001"
        collection = F.when(first, F.lit("CC-MAIN-2008-2009")).otherwise(F.lit("CC-MAIN-2009-2010"))
        fields = {
            "crawl_identifier": collection, "crawl_original_identifier": F.when(first, F.lit("crawl-001")).otherwise(F.lit("crawl-002")), "crawl_provider": "commoncrawl", "crawl_collection_id": collection,
            "file_write_start": _iso_millis(written), "file_partition": partition, "file_segment": F.concat_ws("/", year, month, day, hour),
        }
        return _reading("commoncrawl-2008", n.full.rlike(r"^crawl-00[12]") & number.isNotNull(), F.lit(1.0), fields, "arc")

    return _groups(n.full, r"crawl-(\d+)/(\d{4})/(\d{2})/(\d{2})/(\d+)/(\d+)_(\d+)\.arc\.gz", 7, read)


def _imported_2008(n: Name) -> Column:
    def read(written: Column, partition: Column) -> Column:
        fits = ~n.full.rlike(r"^(crawl-data/CC-MAIN-|parse-output|crawl-00[12])") & F.substring(_iso_millis(written), 1, 4).isin("2008", "2009")
        fields = {"crawl_identifier": "CC-MAIN-2008-2009", "crawl_original_identifier": "crawl-001", "crawl_provider": "commoncrawl", "crawl_collection_id": "CC-MAIN-2008-2009", "file_write_start": _iso_millis(written), "file_partition": partition}
        return _reading("commoncrawl-2008-ia", fits, F.lit(0.6), fields, "arc")

    return _groups(n.full, r"\d{13}_\d+-c/(\d{13})_(\d+)\.arc\.gz", 2, read)


def _generic(base: Column, kind: Column) -> Column:
    """``identifier-stamp-serial-crawler``, the last stamp in the name; of the name with runs of dashes as one, if it doesn't
    fit as it is."""
    ends_with_stamp = r"-(?:19|20)(?:\d{12}|\d{15})$"

    def read(identifier: Column, digits: Column, third: Column, rest: Column) -> Column:
        crawler = F.when(rest.isNotNull(), rest).when(~third.rlike(r"^\d+$"), third)
        serial = F.when(rest.isNotNull() | third.rlike(r"^\d+$"), third)
        written = F.when(F.length(digits) == 17, _iso17(digits)).otherwise(_iso(_moment(digits)))
        return bind(F.struct(crawler.alias("crawler"), crawler_parts(crawler).alias("told"), written.alias("written")), lambda c: filled(identifier, serial, c["crawler"], c["told"], c["written"]))

    def filled(identifier: Column, serial: Column, crawler: Column, told: Column, written: Column) -> Column:
        low = F.lower(F.coalesce(crawler, F.lit("")))
        operator = (
            F.when(low.contains("archive.org") | low.rlike(r"^crawling\d{2,3}$") | low.rlike(r"^ia\d{5,6}$"), F.lit("internetarchive"))
            .when(low.contains("accelovation.com"), F.lit("accelovation"))
            .when(identifier.startswith("IA-FOC-"), F.lit("internetarchive"))
        )
        name = F.when(operator.isNotNull(), F.coalesce(told["crawler_name"], F.substring_index(told["crawler_hostname"], ".", 1))).otherwise(told["crawler_name"])
        host = F.when(operator == "internetarchive", F.coalesce(told["crawler_hostname"], archive_host(name, written))).otherwise(told["crawler_hostname"])
        fields = {"crawl_identifier": identifier, "file_write_start": written, "file_serial_number": serial} | {k: told[k] for k in _CRAWLER_FIELDS} | {"crawler_name": name, "crawler_hostname": host, "crawl_provider": operator}
        return _reading("generic", kind.isNotNull() & identifier.isNotNull() & written.isNotNull(), F.lit(0.4) + _more(operator.isNotNull(), 0.2), fields, kind)

    def once(base: Column) -> Column:
        return _groups(F.when(~base.rlike(ends_with_stamp), base), r"^(.+)-((?:19|20)(?:\d{12}|\d{15}))-([^-]+)(?:-(.*))?$", 4, read)

    return F.coalesce(once(base), bind(F.regexp_replace(base, "-+", "-"), once))


def _playback_2002(n: Name) -> Column:
    def read(before: Column, identifier: Column, after: Column, stamp: Column) -> Column:
        return bind(crawler_parts(F.nullif(F.concat_ws(".", before, after), F.lit(""))), lambda told: filled(identifier, stamp, told))

    def filled(identifier: Column, stamp: Column, told: Column) -> Column:
        name = F.coalesce(told["crawler_name"], F.substring_index(told["crawler_hostname"], ".", 1))
        fields = {"crawl_identifier": identifier, "crawl_provider": "internetarchive", "file_write_end": _iso(_moment(stamp))} | {k: told[k] for k in _CRAWLER_FIELDS}
        fields |= {"crawler_name": name, "crawler_hostname": F.coalesce(told["crawler_hostname"], archive_host(name, stamp))}
        return _reading("wayback-2002", n.arc & _moment(stamp).isNotNull(), _scored(n.within("20020901000000", "20080201000000")), fields, n.format)

    return _groups(n.base, r"^(?:(.*?)\.)?(wb_robots|wb_urls)(?:\.(.*))?\.(\d{14})$", 4, read)


def _playback_2005(n: Name) -> Column:
    def read(identifier: Column, crawler: Column, stamp: Column) -> Column:
        fields = {"crawl_identifier": F.coalesce(identifier, F.lit("")), "crawl_provider": "internetarchive", "file_write_end": _iso(_moment(stamp)), "crawler_name": crawler, "crawler_hostname": archive_host(crawler, stamp)}
        return _reading("wayback-2005", n.arc & _years(_moment(stamp), 2005, 2009), _scored(n.within("20050101000000", "20100101000000")), fields, n.format)

    return _groups(n.base, r"^(?:([^.]*)-)?(ia\d+)(?:\.[^.]*)*\.(\d{14})$", 3, read)


def _playback_2012(n: Name) -> Column:
    """Inside an item whose name is the identifier, a stamp and the crawler."""

    def read(identifier: Column, stamp: Column, serial: Column) -> Column:
        item = F.substring_index(n.full, "/", 1)

        def filled(batch: Column, crawler: Column) -> Column:
            fits = n.warc & _years(_moment(stamp), 2010) & item.startswith(identifier) & _moment(batch).isNotNull() & crawler.isNotNull() & ~crawler.rlike(r"^\d+$")
            fields = {"crawl_identifier": identifier, "crawl_provider": "internetarchive", "file_write_start": _iso(_moment(stamp)), "file_serial_number": serial, "crawler_name": crawler, "crawler_hostname": archive_host(crawler, stamp)}
            return _reading("wayback-2012", fits, _scored(n.within("20110101000000")), fields, n.format)

        return _groups(F.substring(item, F.length(identifier) + 2, F.length(item)), r"^(\d{14})-([^-]*)", 2, filled)

    return _groups(n.base, r"^(.+)-(\d{14})-(\d{5})$", 3, read)


def _playback_live(n: Name) -> Column:
    def read(stamp: Column, serial: Column) -> Column:
        fields = {"crawl_identifier": "live", "crawl_provider": "internetarchive", "file_write_start": _iso17(stamp), "file_serial_number": serial}
        return _reading("wayback-live", n.arc & _years(_moment(stamp, 17), 2011, 2013), _scored(n.within("20110101000000", "20130901000000")), fields, n.format)

    return _groups(n.base, r"^live-(?:.*-)?(\d{17})-(\d{5})$", 2, read)


def _playback_save(n: Name) -> Column:
    def read(identifier: Column, stamp: Column, host: Column, port: Column) -> Column:
        fields = {"crawl_identifier": identifier, "crawl_provider": "internetarchive", "file_write_start": _iso(_moment(stamp)), "crawler_name": F.substring_index(host, ".", 1), "crawler_hostname": F.concat(host, F.lit(":"), port)}
        return _reading("wayback-spn", n.warc & _years(_moment(stamp), 2020), _scored(n.within("20200101000000")), fields, n.format)

    return _groups(n.base, r"^(spn2)-(\d{14})-(.+)-(\d+)$", 4, read)


def _details(reading: Column) -> dict[str, Column]:
    return {name: reading["details"][name] for name, _ in FIELDS}


def _portuguese(n: Name) -> Column:
    def read(identifier: Column) -> Column:
        without_year = F.when(identifier.rlike(r"^.{4,}2\d{3}$"), F.regexp_replace(identifier, r"\d{4}$", "")).otherwise(identifier)
        fits = n.full.startswith("portuguese-web-archive") & (n.generic["details"]["crawl_identifier"] == "IAH")
        return _reading("arquivo-pt", fits, F.lit(1.0), _details(n.generic) | {"crawl_provider": "arquivo-pt", "crawl_identifier": without_year}, n.format)

    return _groups(n.full, r"^portuguese-web-archive-?([^/-]*)", 1, read)


def _historical(n: Name) -> Column:
    fields = _details(n.generic) | {"file_write_start": None, "crawl_processing": n.generic["details"]["file_write_start"], "crawl_year": _group(n.full, r"(?:^|-)([12]\d{3})(?=-|$)", 1), "crawl_provider": "alexa"}
    return _reading("ina-historical", n.arc & n.file.startswith("INA-HISTORICAL-") & n.generic["details"]["crawl_identifier"].startswith("INA-HISTORICAL-"), F.lit(1.0), fields, n.format)


def _library(n: Name) -> Column:
    fits = n.file.startswith("CDL-") & F.substring(n.generic["details"]["file_write_start"], 1, 4).isin("2008", "2009")
    return _reading("cdl", fits, F.lit(1.0), _details(n.generic) | {"crawl_provider": "cdl"}, n.format)


def _bot(n: Name, label: str, pattern: str, count: int, more: Callable[..., dict[str, Column]]) -> Column:
    def read(identifier: Column, depth: Column, day: Column, clock: Column, *rest: Column) -> Column:
        started = _moment(F.concat(day, clock))
        own = more(*rest)
        fields = {"crawl_identifier": F.coalesce(identifier, F.lit("")), "crawl_provider": "archiveteam", "crawl_depth": depth, "file_write_start": _iso(started), "crawl_flags": F.when(own.pop("aborted").isNotNull(), F.array(F.lit("aborted")))}
        return _reading(label, n.warc & n.full.startswith("archiveteam_archivebot_go_") & started.isNotNull(), F.lit(1.0), fields | own, n.format)

    return _groups(n.base, pattern, count, read)


def _bot_2013(n: Name) -> Column:
    return _bot(n, "archiveteam-go-pack-2013", r"^(?:(.*)-)?([^-]*)-(\d{8})-(\d{6})(-aborted)?$", 5, lambda aborted: {"aborted": aborted})


def _bot_2014(n: Name) -> Column:
    more = lambda job, aborted, serial: {"aborted": aborted, "crawl_job_id": job, "file_serial_number": serial}
    return _bot(n, "archiveteam-go-pack-2014", r"^(?:(.*)-)?([^-]*)-(\d{8})-(\d{6})-(?!aborted-)([^-]*)(-aborted)?-(\d+)$", 7, more)


def _warrior(n: Name) -> Column:
    def read(identifier: Column, stamp: Column, job: Column, seconds: Column) -> Column:
        fields = {"crawl_identifier": F.coalesce(identifier, F.lit("")), "crawl_provider": "archiveteam", "file_write_start": _iso(_epoch(seconds)), "crawl_processing": _iso(_moment(stamp)), "crawl_job_id": job}
        return _reading("archiveteam-warrior", n.warc & n.full.rlike(r"^archiveteam_(?!archivebot_go_)") & _moment(stamp).isNotNull(), F.lit(1.0), fields, n.format)

    return _groups(n.base, r"^([^.]*)_(\d{14})(?:_([a-f0-9]{8}))?(?:\.([1-9]\d*))?\.megawarc$", 4, read)


def _early(n: Name) -> Column:
    def read(identifier: Column, year: Column, month: Column, day: Column, job: Column, serial: Column) -> Column:
        date = _date(F.concat(year, month, day))
        fields = {"crawl_identifier": F.coalesce(identifier, F.lit("")), "crawl_provider": "archiveteam", "crawl_start_date": date, "crawl_job_id": job, "file_serial_number": serial}
        return _reading("archiveteam-early-warc", n.warc & n.full.startswith("warc-") & date.isNotNull(), F.lit(1.0), fields, n.format)

    return _groups(n.base, r"^(.*)-(\d{4})-(\d{2})-(\d{2})-([a-f0-9]{8})-(\d+)$", 6, read)


def _subscribed_library(n: Name) -> Column:
    def read(collection: Column, stamp: Column, serial: Column, crawler: Column) -> Column:
        fields = {"crawl_identifier": F.concat(F.lit("ARCHIVEIT-"), collection, F.lit("-CDL")), "crawl_collection_id": collection, "file_write_start": _iso(_moment(stamp)), "file_serial_number": serial, "crawler_name": crawler, "crawl_provider": "cdl"}
        return _reading("archiveit-cdl", n.arc & _moment(stamp).isNotNull(), F.lit(1.0), fields, n.format)

    return _groups(n.base, r"^ARCHIVEIT-(\d+)-CDL-(\d{14})-(\d+)(?:-(.*?))?(?:-(\d{8}))?$", 4, read)


def _subscribed_external(n: Name) -> Column:
    def read(collection: Column, stamp: Column, rest: Column) -> Column:
        def filled(inner: Column) -> Column:
            own = {"crawl_identifier": F.concat(F.lit("ARCHIVEIT-"), collection, F.lit("-EXTERNAL")), "crawl_original_identifier": inner["details"]["crawl_identifier"], "crawl_collection_id": collection, "crawl_processing": _iso(_moment(stamp))}
            return _reading("archiveit-external", n.format.isNotNull() & _moment(stamp).isNotNull(), F.lit(1.0), _details(inner) | own, n.format)

        return bind(_generic(rest, n.format), filled)

    return _groups(n.base, r"^ARCHIVEIT-(\d+)-EXTERNAL-(\d{14})(?:-(.*))?$", 3, read)


def _subscribed(n: Name, label: str, pattern: str, keys: tuple[str, ...], years: tuple[int, int], window: Column, kind: Column, more: Callable[[dict[str, Column]], dict[str, Column]] = dict) -> Column:
    """Layouts that begin with ARCHIVEIT and a collection; ``keys`` names the pattern's groups, among them stamp."""
    regular = n.base.startswith("ARCHIVEIT-") & ~n.base.rlike(r"^ARCHIVEIT-\d+-(EXTERNAL|CDL|WAYBACKFILL|EXTRACTION)-")

    def read(*found: Column) -> Column:
        taken = dict(zip(keys, found, strict=True))
        stamp = taken.pop("stamp")
        fine = F.length(stamp) == 17
        written = F.when(fine, _iso17(stamp)).otherwise(_iso(_moment(stamp)))
        year = _years(F.coalesce(_moment(stamp), _moment(stamp, 17)), *years)
        return _reading(label, kind & regular & year, _scored(window), {"file_write_start": written, "crawl_provider": "internetarchive"} | more(taken), n.format)

    return _groups(n.base, pattern, len(keys), read)


def _subscribed_layouts(n: Name) -> list[Column]:
    head = ("crawl_identifier", "crawl_collection_id")
    job = (*head, "crawl_interval", "crawl_job_id", "stamp", "file_serial_number")
    seed = (*head, "crawl_interval", "crawl_job_id", "crawl_seed_id", "stamp", "file_serial_number")
    ported = (*job, "host", "port")
    start = r"^(ARCHIVEIT-(\d+)-([^-]*)-({}))-"

    def with_port(taken: dict[str, Column]) -> dict[str, Column]:
        host, port = (F.coalesce(taken.pop(k), F.lit("")) for k in ("host", "port"))
        return taken | {"crawler_name": F.concat(host, F.lit(":"), port)}

    def with_suffix(taken: dict[str, Column]) -> dict[str, Column]:
        return taken | {"crawl_identifier": F.concat(F.lit("ARCHIVEIT-"), taken["crawl_collection_id"], F.lit("-"), F.coalesce(taken.pop("suffix"), F.lit("")))}

    long_enough = F.size(F.split(n.base, "-")) >= 6
    return [
        _subscribed(n, "archiveit-brozzler", start.format(r"JOB\d+") + r"(?:[^-]*-)?(SEED\d+)-(\d{17})-(\d+)-(?:.*-)?([^-]{8})$", (*seed, "crawl_token"), (2017, 9999), n.within("20170101000000"), n.warc),
        _subscribed(n, "archiveit-2006", r"^ARCHIVEIT-(\d+)(?:-(.+))?-((?:19|20)\d{12})-(\d+)(?:-(.*))?$", ("crawl_collection_id", "suffix", "stamp", "file_serial_number", "crawler_name"), (2006, 2009), n.within("20060101000000", "20090315000000"), n.arc & long_enough, with_suffix),
        _subscribed(n, "archiveit-2009", r"^(ARCHIVEIT-(\d+))-(\d{14})-(\d+)-(.+)$", (*head, "stamp", "file_serial_number", "crawler_name"), (2009, 2009), n.within("20090315000000", "20100101000000", True), n.format.isNotNull()),
        _subscribed(n, "archiveit-2010", start.format("[A-Z]{6}") + r"(\d{14})-(\d+)-(?:(.*)-)?([^-]*)$", ported, (2010, 2013), n.within("20100101000000", "20140101000000", True), n.warc, with_port),
        _subscribed(n, "archiveit-2013", start.format(r"\d+") + r"(\d{17})-(\d+)-(?:(.*)-)?([^-]*)$", ported, (2013, 2015), n.within("20130101000000", "20160101000000", True), n.warc, with_port),
        _subscribed(n, "archiveit-2015", start.format(r"JOB\d+") + r"(\d{17})-(\d+)(?:-.*)?$", job, (2015, 2018), n.within("20150201000000", "20181001000000", True), n.warc),
        _subscribed(n, "archiveit-2018", start.format(r"JOB\d+") + r"(SEED\d+)-(\d{17})-(\d+)-(?:.*-)?h3$", seed, (2018, 9999), n.within("20180901000000"), n.warc),
    ]


#: The families of layouts, in the order in which equal scores are told apart.
FAMILIES: dict[str, Callable[[Name], list[Column]]] = {
    "alexa": lambda n: [f(n) for f in (_tagged_1996, _dashed_1998, _images_2000_04, _recy_2000_06, _images_2000_07, _dated_2000_07, _dotted_2000_11, _underscored_2001, _election_2002, _sequence_2005, _sequence_2006)],
    "compaq": lambda n: [f(n) for f in (_compaq_regular, _compaq_image, _compaq_election)],
    "commoncrawl": lambda n: [f(n) for f in (_segments_2017, _segments_2013, _segments_2012, _numbered_2008, _imported_2008)],
    "generic": lambda n: [n.generic],
    "playback": lambda n: [f(n) for f in (_playback_2002, _playback_2005, _playback_2012, _playback_live, _playback_save)],
    "specialised": lambda n: [f(n) for f in (_portuguese, _historical, _library)],
    "team": lambda n: [f(n) for f in (_bot_2013, _bot_2014, _warrior, _early)],
    "subscribed": lambda n: [_subscribed_library(n), _subscribed_external(n), *_subscribed_layouts(n)],
}


#: What a name must hold for a layout of the family to fit: one search of the whole name each, so that names are read by the families that may fit alone.
SIGNS: dict[str, str] = {
    "alexa": r"(?:^|/)(?:(?:[A-Z]{2}|F2|IA-E96)-\d+[A-Z]?\.|(?:" + "|".join(IDENTIFIERS_1998) + r"|2000|test|short|crc|Recy|IMG_A)[^/]*-[1-9]\d*(?:\.|$)|(?:crc|arc)\d+\.\d{14}|[^/]*_(?:arc|crc|crawl|alexa)\d+_?\.\d{14}|\d+_\d+_\d{14}_crawl)",
    "compaq": r"(?:^|/)(?:(?:aug|image)-\d{12}|IMG_X|unique\.\d{14})",
    "commoncrawl": r"^(?:crawl-data/CC-MAIN-|parse-output|crawl-00[12])|\d{13}_\d+-c/",
    "generic": r"-(?:19|20)\d{12}[^/]*$",
    "playback": r"(?:wb_robots|wb_urls)[^/]*$|(?:^|[/-])ia\d+[^/]*\.\d{14}|-\d{14}-\d{5}|(?:^|/)(?:live|spn2)-",
    "specialised": r"^portuguese-web-archive|(?:^|/)(?:INA-HISTORICAL|CDL)-",
    "team": r"^(?:archiveteam_|warc-)",
    "subscribed": r"(?:^|/)ARCHIVEIT-",
}


def may_be_of(name: Column, families: tuple[str, ...] = tuple(FAMILIES)) -> Column:
    """The families of which a layout may fit the name, as bits in their order."""
    bits = [F.when(name.rlike(SIGNS[f]), F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(families)]
    out = F.lit(0)
    for b in bits:
        out = out.bitwiseOR(b)
    return out


def _readings(name: Column, stamp: Column | None, families: tuple[str, ...]) -> Column:
    """An array of the reading of each layout, in the order of ``FAMILIES``, nulls where one doesn't fit."""

    def readings(parts: Column) -> Column:
        n = Name(parts)

        def with_generic(generic: Column | None) -> Column:
            n.generic = generic
            layouts = [reading for key, family in FAMILIES.items() if key in families for reading in family(n)]
            return F.array(*layouts)

        if {"generic", "specialised"}.isdisjoint(families):
            return with_generic(None)
        return bind(_generic(n.base, n.format), with_generic)

    return bind(Name.parts(name, F.lit(None).cast("string") if stamp is None else stamp), readings)


def best_reading(readings: Column) -> Column:
    """Of an array of readings that with the best score, of equal ones the first; null if all are."""
    ranked = F.transform(readings, lambda r, i: F.when(r.isNotNull(), F.struct(r["confidence"].alias("confidence"), (-i).alias("place"), r.alias("reading"))))
    return F.array_max(ranked)["reading"]


def archive_name_candidates(name: Column, stamp: Column | None = None, families: tuple[str, ...] = tuple(FAMILIES)) -> Column:
    """All readings of a name, best first, equal scores in the order of ``FAMILIES``: an array of (confidence, layout,
    record_format, details).

    ``stamp`` is the 14-digit stamp of a capture in the file: it raises the score of layouts in whose time it lies.
    Null and empty names, and those of an unknown extension, have none.
    """
    found = F.filter(_readings(name, stamp, families), lambda x: x.isNotNull())
    ranked = F.transform(found, lambda x, i: F.struct(x["confidence"].alias("confidence"), (-i).alias("place"), x.alias("reading")))
    return F.transform(F.array_sort(ranked, lambda x, y: F.when(x["confidence"] != y["confidence"], F.when(x["confidence"] > y["confidence"], -1).otherwise(1)).otherwise(y["place"] - x["place"])), lambda x: x["reading"])


def archive_name(name: Column, stamp: Column | None = None, families: tuple[str, ...] = tuple(FAMILIES)) -> Column:
    """The reading with the best score, of equal ones the first in ``FAMILIES``; null if no layout fits."""
    return best_reading(_readings(name, stamp, families))
