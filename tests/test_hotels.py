"""Hotel sources: attributes against an HTML parser, page JSON, calendar rules, the folder job."""

import json
import random
from html.parser import HTMLParser
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakefold.plans.jobs import LINK_BOX, hotel_links, run_hotel_folder
from lakefold.sources import html as H
from lakefold.sources import json_pages as J
from lakefold.storage.table import ArchiveTable
from tests.conftest import SF


class First(HTMLParser):
    """href and title of every anchor."""

    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            got = {}
            for k, v in attrs:
                got.setdefault(k, v or "")
            self.found.append((got.get("href", ""), got.get("title", "")))


def anchors(rng):
    out = []
    for i in range(400):
        parts = []
        for name in rng.sample(["href", "HREF", "title", "data-href", "class", "disabled", "Title"], rng.randint(0, 5)):
            value = "".join(rng.choice("abc/?=&;.é <>") for _ in range(rng.randint(0, 8)))
            form = rng.randint(0, 3)
            gap = rng.choice(["", " ", "\n", "\t "])
            if form == 0:
                parts.append(f'{name}{gap}={gap}"{value}"')
            elif form == 1:
                parts.append(f"{name}{gap}={gap}'{value} \"q\"'")
            elif form == 2:
                parts.append(f"{name}={gap}v{i}/{rng.randint(0, 9)}&amp;x")
            else:
                parts.append(name)
        out.append("<" + rng.choice("aA") + "".join(rng.choice([" ", "\n", "  "]) + p for p in parts) + rng.choice(["", " "]) + ">")
    return out


def test_attributes_like_an_html_parser(spark):
    tags = anchors(random.Random(1))
    got = spark.createDataFrame([(i, t) for i, t in enumerate(tags)], "i int, tag string")
    got = got.select("i", *(H.decode_entities(H.attribute(F.col("tag"), n)).alias(n) for n in ("href", "title"))).orderBy("i").collect()
    for r, tag in zip(got, tags):
        p = First()
        p.feed(tag)
        assert [(r.href, r.title)] == p.found, tag


def test_links_of_all_pages_like_an_html_parser(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html")
    got = H.hotel_links(pages).filter("has_link").groupBy("page_id").agg(F.sort_array(F.collect_list(F.struct("_idx", "path", "title"))).alias("l"))
    got = {r.page_id: [(x.path, x.title) for x in r.l] for r in got.collect()}
    for r in pages.collect():
        class Items(First):
            depth = 0

            def handle_starttag(self, tag, attrs):
                self.depth += tag == "li"
                if self.depth:
                    super().handle_starttag(tag, attrs)

            def handle_endtag(self, tag):
                self.depth -= tag == "li"

        p = Items()
        p.feed(r.html)
        assert got.get(r.page_id, []) == [(h, t.strip()) for h, t in p.found]


def test_containers_are_told_by_a_word_of_their_class(spark):
    box = lambda c, x: f"<div {c}>{x}</div>"
    html = (box(f'id=1 class="a {LINK_BOX} b"', "<a href=x1 title=T>") + box(f"class='{LINK_BOX}'", "<b>no</b>") + box(f"class={LINK_BOX}", "<a HREF = \"/x2\">")
            + box(f'class="{LINK_BOX}-more"', "<a href=no>") + box(f'data-x="class={LINK_BOX}"', "<i>") + box('class="a"', "<a href=no>"))
    got = hotel_links(spark.createDataFrame([(html,), (None,)], "html string"), "https://h.example/").collect()
    assert {(r.url, r.title) for r in got} == {("https://h.example/x1", "T"), ("https://h.example/x2", "")}


def page(**content):
    return {"props": {"pageProps": {"nodeContent": content, "metaTags": {"title": "t & t"}}}}


@pytest.mark.parametrize("text, nid, reasons", [
    (json.dumps(page(nid=5, choicePointsValue="15000", fieldSynxisId=77, fieldNumRooms="12")), 5, []),
    (json.dumps(page(nid="6", fieldIPreferBookWithPoints=True)), 6, []),
    (json.dumps(page(nid=None)), None, ["missing:nid"]), (json.dumps({}), None, ["missing:nid"]), (json.dumps({"props": None}), None, ["missing:nid"]),
    (json.dumps(page(nid="x", fieldNumRooms=2.5, fieldDisplayTitle=3, choicePointsValue={"a": 1}, participatesInChoicePoints="maybe")), None,
     ["type:nid", "type:name", "type:num_rooms", "type:choice_points", "type:book_with_choice"]),
    ("{oops", None, ["json"]), ("", None, ["json"]), (None, None, ["json"]),
])
def test_hotel_details_with_defaults(spark, text, nid, reasons):
    r = J.hotel_details(spark.createDataFrame([("u", text, "mine")], "url string, j string, extra string"), "j").first()
    assert (r.nid, list(r._reasons), r.url, r.extra) == (nid, reasons, "u", "mine")
    if nid == 5:
        assert (r.choice_points, r.synxis_id, r.num_rooms, r.title, r.name, r.book_with_points) == ("15000", "77", 12, "t & t", None, None)


DAY = {"lowestRate": 12.5, "lowestPointsRate": None, "available": True}


@pytest.mark.parametrize("calendar, reasons", [
    ({"count": 1, "results": {"2031-02-03": DAY}}, []), ({"count": 0, "results": []}, []), ({"count": 0}, []),
    ({"results": {"d": {}}}, ["missing:count"]), ({"count": "many", "results": {}}, ["type:count"]),
    ({"count": 2, "results": {"a": DAY, "b": DAY | {"lowestPointsRate": 1.5}}}, ["type:results[].lowestPointsRate"]),
    ({"count": 2, "results": {"a": DAY | {"lowestRate": "x", "available": "no way"}}}, ["type:results[].lowestRate", "type:results[].available"]),
    ({"count": 1, "results": [1]}, ["type:results"]), ({"count": 1, "results": {"a": 3}}, ["type:results[]"]),
    ({"count": 1, "currency_code": 5}, ["type:currency_code"]),
])
def test_calendar_rules_reach_every_day(spark, calendar, reasons):
    got = spark.createDataFrame([(json.dumps(calendar),)], "t string").select(J.calendar_reasons(F.col("t")).alias("r")).first()
    assert list(got.r) == reasons


def test_hotel_job_over_a_folder(spark, scratch):
    landed, root, site = Path(scratch) / "landed", scratch + "/root", "https://h.example"
    link = lambda p: f"<div class='{LINK_BOX}'><a href='{p}' title='x'>x</a></div>"
    tag = "<script id='__NEXT_DATA__'>%s</script>"
    for name in ("directory", "pages", "calendars"):
        (landed / name).mkdir(parents=True)
    (landed / "directory/a.html").write_text("".join(map(link, ["/h/1", "h/2", "/h/1", "/h/9"])))
    (landed / "directory/b.html").write_text("".join(map(link, ["/h/3", "/h/4"])) + f"<div class={LINK_BOX}></div>")
    pages = {1: tag % json.dumps(page(nid=1)), 2: tag % "{" + "<p>", 3: (tag % "{}") * 2, 4: tag % json.dumps(page(nid=4, fieldNumRooms=9))}
    (landed / "pages/p.json").write_text("".join(json.dumps({"url": f"{site}/h/{k}", "html": v}) + "\n" for k, v in pages.items()))
    good = json.dumps({"count": 2, "currency_code": "NOK", "results": {"2031-02-03": DAY, "2031-02-04": DAY}})
    bad = json.dumps({"count": 1, "results": {"2031-02-03": {"available": 7.5}}})
    rows = [(1, False, good), (1, True, bad), (4, True, json.dumps({"count": 0, "results": []})), (77, False, good)]
    (landed / "calendars/c.json").write_text("".join(json.dumps(dict(zip(("nid", "is_points", "text"), r))) + "\n" for r in rows))
    st = run_hotel_folder(spark, str(landed), root, site)
    assert st["hotels"]["rows_inserted"] == 2 and st["availability"]["rows_inserted"] == 2
    assert st["rejects"] == {"missing:page": 1, "json": 1, "scripts:2": 1, "type:results[].available": 1}
    hotels = {r.nid: (r.url, r.num_rooms, r.title) for r in ArchiveTable(spark, root + "/hotels").current().collect()}
    assert hotels == {1: (f"{site}/h/1", None, "t & t"), 4: (f"{site}/h/4", 9, "t & t")}
    again = run_hotel_folder(spark, str(landed), root, site)
    assert again["hotels"]["rows_written"] == 0 and again["availability"]["rows_written"] == 0


ROUTE = {"ID": "r", "OriginAirport": "OSL", "OriginRegion": "Nordics", "DestinationAirport": "BGO", "DestinationRegion": "Nordics",
         "NumDaysOut": 60, "Distance": "330", "Source": "nosuch"}


@pytest.mark.parametrize("text, reasons", [
    (json.dumps([ROUTE, ROUTE]), []), ("[]", []), (json.dumps(ROUTE), ["type:routes"]), ("[{", ["json"]), (json.dumps([ROUTE, 4]), ["type:routes[]"]),
    (json.dumps([ROUTE, {k: v for k, v in ROUTE.items() if k != "ID"}, ROUTE | {"NumDaysOut": 1.5, "Source": None}]),
     ["missing:routes[].ID", "type:routes[].NumDaysOut", "missing:routes[].Source"]),
])
def test_route_rules_reach_every_route(spark, text, reasons):
    got = spark.createDataFrame([(text,)], "t string").select(J.route_reasons(F.col("t")).alias("r")).first()
    assert list(got.r) == reasons
