"""Registered queries of archive file names.

Each query writes names of every layout of its families from the attributes of captures, reads them, and its SQL tells
the fields from those attributes.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from arkspark.operators import archive_files
from arkspark.plans.queries import QUERIES, SQL
from arkspark.sources.captures import CAPTURES_SQL, captures

_COLUMNS = ("crawl_identifier", "crawl_original_identifier", "crawl_provider", "crawl_collection_id", "crawl_generation_code", "crawl_job_id", "crawl_seed_id", "crawl_interval", "crawl_depth", "crawl_subset", "crawler_name", "crawler_hostname", "crawl_start_date", "crawl_batch_start", "file_write_start", "file_write_end", "crawl_processing", "file_serial_number", "file_partition", "file_segment")
_O5, _O6, _O9 = (f"lpad(CAST(ord AS STRING), {n}, '0')" for n in (5, 6, 9))


def _stamp(year: int) -> str:
    return f"concat('{year}', substr(ts14, 5, 10))"


def _iso(year: int, more: str = "") -> str:
    return f"concat('{year}-', substr(ts14, 5, 2), '-', substr(ts14, 7, 2), 'T', substr(ts14, 9, 2), ':', substr(ts14, 11, 2), ':', substr(ts14, 13, 2), '{more}Z')"


def _text(x: str) -> str:
    return f"'{x}'"


def _seconds(start: int) -> str:
    """DuckDB: the ISO time of an epoch."""
    return f"strftime(make_timestamp(({start} + ord) * 1000000), '%Y-%m-%dT%H:%M:%SZ')"


def _pacific(year: int) -> str:
    """DuckDB: in UTC, a local time of January."""
    return f"strftime(strptime({_stamp(year)}, '%Y%m%d%H%M%S') + INTERVAL 8 HOUR, '%Y-%m-%dT%H:%M:%SZ')"


# (layout, name, score without and with the capture's stamp, year of that stamp, fields)
_EARLY = [
    ("alexa-1996", f"concat('FS-', {_O6}, '.arc.gz')", (0.75, 1), 1997, {"crawl_identifier": "'FS'", "crawler_name": "'firestone'", "file_serial_number": _O6}),
    ("alexa-1998", f"concat('green-', {_O6}, '-', {_stamp(1999)}, '-', CAST(930000000 + ord AS STRING), '.arc.gz')", (0.8, 1), 1999, {"crawl_identifier": "'green'", "crawler_name": "'green'", "crawl_batch_start": _pacific(1999), "file_write_start": _seconds(930000000), "file_serial_number": _O6}),
    ("alexa-2000-04-image", "concat('crc47-2-aa-', CAST(958000000 + ord AS STRING), '.arc.gz')", (0.8, 0.8), 2001, {"crawl_identifier": "'crc47'", "crawler_name": "'crc47'", "file_write_start": _seconds(958000000), "file_serial_number": "'aa'"}),
    ("alexa-2000-06-recy-crawl", "concat('Recy20000602aa-', CAST(961000000 + ord AS STRING), '.arc.gz')", (0.8, 0.8), 2001, {"crawl_identifier": "'Recy20000602'", "crawl_start_date": "'2000-06-02'", "file_write_start": _seconds(961000000), "file_serial_number": "'aa'"}),
    ("alexa-2000-07-image", "concat('IMG_AQR_SUBaa_1-', CAST(968000000 + ord AS STRING), '.arc.gz')", (0.8, 0.8), 2001, {"crawl_identifier": "'IMG_AQR'", "crawl_generation_code": "'AQR'", "file_write_start": _seconds(968000000), "file_serial_number": "'aa_1'"}),
    ("alexa-2000-07", f"concat('20000710.', {_O6}, '-', {_stamp(2000)}, '-', CAST(964000000 + ord AS STRING), '.arc.gz')", (0.8, 0.8), 2001, {"crawl_identifier": "'20000710'", "crawl_start_date": "'2000-07-10'", "crawl_batch_start": _pacific(2000), "file_write_start": _seconds(964000000), "file_serial_number": _O6}),
    ("alexa-2000-11", f"concat('crc58.', {_stamp(2001)}, '.arc.gz')", (0.8, 1), 2001, {"crawl_identifier": "'crc58'", "crawler_name": "'crc58'", "file_write_start": _iso(2001)}),
    ("alexa-2001-05", f"concat('DQ_images_crawl', CAST(ord AS STRING), '.', {_stamp(2004)}, '.arc.gz')", (0.8, 1), 2004, {"crawl_identifier": "'DQ_images'", "crawl_generation_code": "'DQ'", "crawl_subset": "'images'", "crawler_name": "concat('crawl', CAST(ord AS STRING))", "file_write_start": _iso(2004)}),
    ("alexa-2002-election", f"concat('E02_6h_', {_O5}, '_crawl12.', {_stamp(2002)}, '.arc.gz')", (0.8, 1), 2002, {"crawl_identifier": "'E02_6h'", "crawl_interval": "'6h'", "crawler_name": "'crawl12'", "file_write_start": _iso(2002), "file_serial_number": _O5}),
    ("alexa-2005-08", f"concat('EK_dad_7_0_crawl', CAST(ord AS STRING), '_.', {_stamp(2006)}, '.arc.gz')", (0.8, 1), 2006, {"crawl_identifier": "'EK_dad_7_0'", "crawl_generation_code": "'EK'", "crawl_subset": "'dad'", "crawler_name": "concat('crawl', CAST(ord AS STRING))", "file_write_start": _iso(2006)}),
    ("alexa-2005-08", f"concat('alexa20150911-07/88_', CAST(ord AS STRING), '_', {_stamp(2015)}, '_crawl777_IndexOnly.arc.gz')", (0.8, 1), 2015, {"crawl_identifier": "concat('88_', CAST(ord AS STRING), '_IndexOnly')", "crawl_subset": "'IndexOnly'", "crawl_start_date": "'2015-09-11'", "crawler_name": "'crawl777'", "file_write_start": _iso(2015)}),
]
_EARLY = [(a, b, c, d, e | {"crawl_provider": "'alexa'"}) for a, b, c, d, e in _EARLY]

_CC = {"crawl_provider": "'commoncrawl'"}
_CRAWLS = [
    ("compaqsrc-regular", f"concat('image-', substr({_stamp(2000)}, 3), '.arc')", (0.8, 0.8), 2001, {"crawl_identifier": "'image'", "crawl_provider": "'compaq-src'", "crawler_name": "'crawler1'", "file_write_start": _pacific(2000)}),
    ("compaqsrc-image", f"concat('IMG_XQR_', substr({_stamp(2000)}, 3), '.arc.gz')", (0.8, 0.8), 1999, {"crawl_identifier": "'IMG_XQR'", "crawl_provider": "'compaq-src'", "crawl_generation_code": "'XQR'", "file_write_start": _pacific(2000)}),
    ("compaqsrc-election2000", f"concat('unique.', {_stamp(2001)}, '.arc.gz')", (0.8, 1), 2001, {"crawl_identifier": "'unique'", "crawl_provider": "'compaq-src'", "crawl_processing": _iso(2001)}),
    ("commoncrawl-2017", f"concat('crawl-data/CC-MAIN-2017-40/segments/1500000000123.45/warc/CC-MAIN-', {_stamp(2017)}, '-', {_stamp(2018)}, '-', {_O5}, '.warc.gz')", (1, 1), 2017, _CC | {"crawl_identifier": "'CC-MAIN-2017-40'", "crawl_collection_id": "'CC-MAIN-2017-40'", "crawl_subset": "'warc'", "file_write_start": _iso(2017), "file_write_end": _iso(2018), "file_serial_number": _O5, "file_partition": "'45'", "file_segment": "'1500000000123.45'"}),
    ("commoncrawl-2013", f"concat('crawl-data/CC-MAIN-2013-48/segments/1380000000777/robotstxt/CC-MAIN-', {_stamp(2013)}, '-00031-ip-10-1-2-', CAST(ord AS STRING), '.ec2.internal.warc.gz')", (1, 1), 2013, _CC | {"crawl_identifier": "'CC-MAIN-2013-48'", "crawl_collection_id": "'CC-MAIN-2013-48'", "crawl_subset": "'robotstxt'", "crawler_name": "concat('ip-10-1-2-', CAST(ord AS STRING), '.ec2.internal')", "file_write_start": _iso(2013), "file_serial_number": "'00031'", "file_segment": "'1380000000777'"}),
    ("commoncrawl-2012", f"concat('parse-output/segment/1346111222333/1346', {_O9}, '_', CAST(ord AS STRING), '.arc.gz')", (1, 1), 2012, _CC | {"crawl_identifier": "'CC-MAIN-2012'", "crawl_collection_id": "'CC-MAIN-2012'", "file_write_start": "strftime(make_timestamp((1346000000000 + ord) * 1000), '%Y-%m-%dT%H:%M:%S.%gZ')", "file_partition": "CAST(ord AS STRING)", "file_segment": "'1346111222333'"}),
    ("commoncrawl-2008", f"concat('crawl-002/2009/10/03/27/1254', {_O9}, '_27.arc.gz')", (1, 1), 2009, _CC | {"crawl_identifier": "'CC-MAIN-2009-2010'", "crawl_original_identifier": "'crawl-002'", "crawl_collection_id": "'CC-MAIN-2009-2010'", "file_write_start": "strftime(make_timestamp((1254000000000 + ord) * 1000), '%Y-%m-%dT%H:%M:%S.%gZ')", "file_partition": "'27'", "file_segment": "'2009/10/03/27'"}),
    ("commoncrawl-2008-ia", f"concat('1223000000555_12-c/1223', {_O9}, '_19.arc.gz')", (0.6, 0.6), 2008, _CC | {"crawl_identifier": "'CC-MAIN-2008-2009'", "crawl_original_identifier": "'crawl-001'", "crawl_collection_id": "'CC-MAIN-2008-2009'", "file_write_start": "strftime(make_timestamp((1223000000000 + ord) * 1000), '%Y-%m-%dT%H:%M:%S.%gZ')", "file_partition": "'19'"}),
]

_IA = {"crawl_provider": "'internetarchive'"}
_PLAYBACK = [
    ("generic", f"concat('LIB-HARVEST-009-', {_stamp(2007)}, '-', {_O5}, '-crawling301.us.archive.org.arc.gz')", (0.6, 0.6), 2007, _IA | {"crawl_identifier": "'LIB-HARVEST-009'", "file_write_start": _iso(2007), "file_serial_number": _O5, "crawler_name": "'crawling301'", "crawler_hostname": "'crawling301.us.archive.org'"}),
    ("generic", f"concat('BROAD--', {_stamp(2010)}, '812-', {_O5}, '-20101~ia100200.us.archive.org~9555.warc.gz')", (0.6, 0.6), 2010, _IA | {"crawl_identifier": "'BROAD-'", "file_write_start": _iso(2010, ".812"), "file_serial_number": _O5, "crawler_name": "'ia100200'", "crawler_hostname": "'ia100200.us.archive.org:9555'"}),
    ("generic", f"concat('SUN-', {_stamp(2006)}, '-', {_O5}, '-simple.arc.gz')", (0.4, 0.4), 2006, {"crawl_identifier": "'SUN'", "file_write_start": _iso(2006), "file_serial_number": _O5, "crawler_name": "'simple'"}),
    ("wayback-2002", f"concat('wb_robots.ia', CAST(ord AS STRING), '.', {_stamp(2004)}, '.arc.gz')", (0.8, 1), 2004, _IA | {"crawl_identifier": "'wb_robots'", "file_write_end": _iso(2004), "crawler_name": "concat('ia', CAST(ord AS STRING))", "crawler_hostname": "concat('ia', CAST(ord AS STRING), '.archive.org')"}),
    ("wayback-2005", f"concat('IA-GARDENS-ia', CAST(ord AS STRING), '.', {_stamp(2008)}, '.arc.gz')", (0.8, 1), 2008, _IA | {"crawl_identifier": "'IA-GARDENS'", "file_write_end": _iso(2008), "crawler_name": "concat('ia', CAST(ord AS STRING))", "crawler_hostname": "concat('ia', CAST(ord AS STRING), '.us.archive.org')"}),
    ("wayback-2012", f"concat('FOCUS-20130405060708-crawl512/FOCUS-', {_stamp(2013)}, '-', {_O5}, '.warc.gz')", (0.8, 1), 2013, _IA | {"crawl_identifier": "'FOCUS'", "file_write_start": _iso(2013), "file_serial_number": _O5, "crawler_name": "'crawl512'", "crawler_hostname": "'crawl512.us.archive.org'"}),
    ("wayback-live", f"concat('live-', {_stamp(2012)}, '275-', {_O5}, '.arc.gz')", (0.8, 1), 2012, _IA | {"crawl_identifier": "'live'", "file_write_start": _iso(2012, ".275"), "file_serial_number": _O5}),
    ("wayback-spn", f"concat('spn2-', {_stamp(2025)}, '-wwwb-spn77.us.archive.org-', CAST(ord AS STRING), '.warc.gz')", (0.8, 1), 2025, _IA | {"crawl_identifier": "'spn2'", "file_write_start": _iso(2025), "crawler_name": "'wwwb-spn77'", "crawler_hostname": "concat('wwwb-spn77.us.archive.org:', CAST(ord AS STRING))"}),
    ("arquivo-pt", f"concat('portuguese-web-archive-AWP52010-12/IAH-', {_stamp(2010)}, '-', {_O5}, '-p31.arquivo.pt.arc.gz')", (1, 1), 2010, {"crawl_provider": "'arquivo-pt'", "crawl_identifier": "'AWP5'", "file_write_start": _iso(2010), "file_serial_number": _O5, "crawler_hostname": "'p31.arquivo.pt'"}),
    ("ina-historical", f"concat('INA-HISTORICAL-2004-GROUP-QRS-', {_stamp(2010)}, '-', {_O5}, '.arc.gz')", (1, 1), 2010, {"crawl_provider": "'alexa'", "crawl_identifier": "'INA-HISTORICAL-2004-GROUP-QRS'", "crawl_processing": _iso(2010), "file_serial_number": _O5}),
    ("cdl", f"concat('CDL-', {_stamp(2009)}, '-', {_O5}, '-dp08.warc.gz')", (1, 1), 2009, {"crawl_provider": "'cdl'", "crawl_identifier": "'CDL'", "file_write_start": _iso(2009), "file_serial_number": _O5, "crawler_name": "'dp08'"}),
    (None, f"concat('notes-', {_O5}, '.txt')", (None, None), 2009, {}),
]

_TEAM = {"crawl_provider": "'archiveteam'"}
_SUBSCRIBED = [
    ("archiveteam-go-pack-2013", f"concat('archiveteam_archivebot_go_041/forum.example.org-inf-', substr({_stamp(2013)}, 1, 8), '-', substr({_stamp(2013)}, 9), '-aborted.warc.gz')", (1, 1), 2013, _TEAM | {"crawl_identifier": "'forum.example.org'", "crawl_depth": "'inf'", "file_write_start": _iso(2013)}),
    ("archiveteam-go-pack-2014", f"concat('archiveteam_archivebot_go_112/lists.example.net-inf-', substr({_stamp(2014)}, 1, 8), '-', substr({_stamp(2014)}, 9), '-q7x2m-', {_O5}, '.warc.gz')", (1, 1), 2014, _TEAM | {"crawl_identifier": "'lists.example.net'", "crawl_depth": "'inf'", "crawl_job_id": "'q7x2m'", "file_write_start": _iso(2014), "file_serial_number": _O5}),
    ("archiveteam-warrior", f"concat('archiveteam_pages_20250410111213/pages_', {_stamp(2025)}, '_a1b2c3d4.', CAST(1741000000 + ord AS STRING), '.megawarc.warc.zst')", (1, 1), 2025, _TEAM | {"crawl_identifier": "'pages'", "crawl_job_id": "'a1b2c3d4'", "crawl_processing": _iso(2025), "file_write_start": _seconds(1741000000)}),
    ("archiveteam-early-warc", f"concat('warc-news.example.org/news.example.org-static-2015-', substr(ts14, 5, 2), '-', substr(ts14, 7, 2), '-0f1e2d3c-', {_O5}, '.warc.gz')", (1, 1), 2015, _TEAM | {"crawl_identifier": "'news.example.org-static'", "crawl_job_id": "'0f1e2d3c'", "crawl_start_date": "concat('2015-', substr(ts14, 5, 2), '-', substr(ts14, 7, 2))", "file_serial_number": _O5}),
    ("archiveit-cdl", f"concat('ARCHIVEIT-7117-CDL-', {_stamp(2015)}, '-', {_O5}, '-cdl-wascraw-p77.ucop.edu-00123456.arc.gz')", (1, 1), 2015, {"crawl_provider": "'cdl'", "crawl_identifier": "'ARCHIVEIT-7117-CDL'", "crawl_collection_id": "'7117'", "file_write_start": _iso(2015), "file_serial_number": _O5, "crawler_name": "'cdl-wascraw-p77.ucop.edu'"}),
    ("archiveit-external", f"concat('ARCHIVEIT-815-EXTERNAL-20210102000000-NATLIB-', {_stamp(2008)}, '-', {_O5}, '-node7.example.ca.arc.gz')", (1, 1), 2008, {"crawl_identifier": "'ARCHIVEIT-815-EXTERNAL'", "crawl_original_identifier": "'NATLIB'", "crawl_collection_id": "'815'", "crawl_processing": "'2021-01-02T00:00:00Z'", "file_write_start": _iso(2008), "file_serial_number": _O5, "crawler_hostname": "'node7.example.ca'"}),
    ("archiveit-brozzler", f"concat('ARCHIVEIT-512-MONTHLY-JOB73-0-SEED98-', {_stamp(2025)}, '641-', {_O5}, '-ab3cd9ef.warc.gz')", (0.8, 1), 2025, _IA | {"crawl_identifier": "'ARCHIVEIT-512-MONTHLY-JOB73'", "crawl_collection_id": "'512'", "crawl_interval": "'MONTHLY'", "crawl_job_id": "'JOB73'", "crawl_seed_id": "'SEED98'", "file_write_start": _iso(2025, ".641"), "file_serial_number": _O5}),
    ("archiveit-2006", f"concat('ARCHIVEIT-427-TRIALRUN-SAMPLE-', {_stamp(2008)}, '-', {_O5}, '-crawling205.archive.org.arc.gz')", (0.8, 1), 2008, _IA | {"crawl_identifier": "'ARCHIVEIT-427-TRIALRUN-SAMPLE'", "crawl_collection_id": "'427'", "file_write_start": _iso(2008), "file_serial_number": _O5, "crawler_name": "'crawling205.archive.org'"}),
    ("archiveit-2009", f"concat('ARCHIVEIT-2483-', {_stamp(2009)}, '-', {_O5}, '-crawling44.us.archive.org.warc.gz')", (0.8, 0.8), 2010, _IA | {"crawl_identifier": "'ARCHIVEIT-2483'", "crawl_collection_id": "'2483'", "file_write_start": _iso(2009), "file_serial_number": _O5, "crawler_name": "'crawling44.us.archive.org'"}),
    ("archiveit-2010", f"concat('ARCHIVEIT-2895-HOURLY-QWERTZ-', {_stamp(2010)}, '-', {_O5}, '-crawling44.us.archive.org-8105.warc.gz')", (0.8, 1), 2010, _IA | {"crawl_identifier": "'ARCHIVEIT-2895-HOURLY-QWERTZ'", "crawl_collection_id": "'2895'", "crawl_interval": "'HOURLY'", "crawl_job_id": "'QWERTZ'", "file_write_start": _iso(2010), "file_serial_number": _O5, "crawler_name": "'crawling44.us.archive.org:8105'"}),
    ("archiveit-2013", f"concat('ARCHIVEIT-4771-MONTHLY-30968-', {_stamp(2014)}, '718-', {_O5}, '-wbgrp-crawl404.us.archive.org-6551.warc.gz')", (0.8, 1), 2014, _IA | {"crawl_identifier": "'ARCHIVEIT-4771-MONTHLY-30968'", "crawl_collection_id": "'4771'", "crawl_interval": "'MONTHLY'", "crawl_job_id": "'30968'", "file_write_start": _iso(2014, ".718"), "file_serial_number": _O5, "crawler_name": "'wbgrp-crawl404.us.archive.org:6551'"}),
    ("archiveit-2015", f"concat('ARCHIVEIT-4771-MONTHLY-JOB30968-', {_stamp(2016)}, '718-', {_O5}, '.warc.gz')", (0.8, 1), 2016, _IA | {"crawl_identifier": "'ARCHIVEIT-4771-MONTHLY-JOB30968'", "crawl_collection_id": "'4771'", "crawl_interval": "'MONTHLY'", "crawl_job_id": "'JOB30968'", "file_write_start": _iso(2016, ".718"), "file_serial_number": _O5}),
    ("archiveit-2018", f"concat('ARCHIVEIT-4771-MONTHLY-JOB30968-SEED77-', {_stamp(2019)}, '718-', {_O5}, '-h3.warc.gz')", (0.8, 1), 2019, _IA | {"crawl_identifier": "'ARCHIVEIT-4771-MONTHLY-JOB30968'", "crawl_collection_id": "'4771'", "crawl_interval": "'MONTHLY'", "crawl_job_id": "'JOB30968'", "crawl_seed_id": "'SEED77'", "file_write_start": _iso(2019, ".718"), "file_serial_number": _O5}),
]


def _by_turns(values: list[str]) -> str:
    return f"CASE ord % {len(values)} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


def _register(title: str, layouts: list[tuple]) -> None:
    """Every other row tells the capture's stamp."""
    name, stamp = _by_turns([x[1] for x in layouts]), f"CASE WHEN ord % 2 = 1 THEN {_by_turns([_stamp(x[3]) for x in layouts])} END"

    def run(spark, d):
        rows = captures(spark, d).select("ord", "ts14").select("ord", F.expr(name).alias("filename"), F.expr(stamp).alias("stamp"))
        read = archive_files.with_archive_names(rows, "filename", "stamp")
        a = F.col("archive_file")
        return read.select("ord", "filename", a["layout"].alias("layout"), F.round(a["confidence"], 3).alias("confidence"), *(a["details"][c].alias(c) for c in _COLUMNS))

    run.__name__ = title
    score = "CASE WHEN ord % 2 = 1 THEN " + _by_turns([f"CAST({x[2][1]} AS DOUBLE)" if x[0] else "NULL" for x in layouts]) + " ELSE " + _by_turns([f"CAST({x[2][0]} AS DOUBLE)" if x[0] else "NULL" for x in layouts]) + " END"
    fields = ", ".join(f"{_by_turns([f'CAST({x[4].get(c, "NULL")} AS STRING)' for x in layouts])} AS {c}" for c in _COLUMNS)
    layout = _by_turns([_text(x[0]) if x[0] else "NULL" for x in layouts])
    QUERIES[title], SQL[title] = run, f"WITH {CAPTURES_SQL} SELECT ord, {name} AS filename, {layout} AS layout, {score} AS confidence, {fields} FROM caps"


_register("archive_names_early", _EARLY)
_register("archive_names_crawls", _CRAWLS)
_register("archive_names_playback", _PLAYBACK)
_register("archive_names_subscribed", _SUBSCRIBED)
