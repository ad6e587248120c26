"""A small site: two years, four groups, three releases, one broken page."""

import datetime

BASE = "https://films.example"
DAY = datetime.date(2024, 5, 1)

LISTING = """
<html><body><a href="/title/tt1/">elsewhere</a>
<table><tr><th>Rank</th><th>Release Group</th><th>Worldwide</th><th>Domestic</th><th>Foreign</th></tr>
{rows}</table>{links}
<table><tr><td>notes</td></tr></table></body></html>
"""


def listing(films):
    rows = "".join(
        f"<tr><td>{i}</td><td><a href='/releasegroup/{g}/?ref_=t{i}'>{title}</a></td>"
        f"<td>{world}</td><td>{home}</td><td>{away}</td></tr>"
        for i, (g, title, world, home, away) in enumerate(films, 1)
    )
    again = "".join(f"<a href='/releasegroup/{film[0]}/?ref_=t{i}'>again</a>" for i, film in enumerate(films, 1))
    return LISTING.format(rows=rows, links=again)


def group(title, links, regions):
    tables = "".join(
        f"<table class='a b releases-by-region'><tr><th colspan='4'>{region}</th></tr>"
        "<tr><th>Market</th><th>Release Date</th><th>Opening</th><th>Gross</th></tr>"
        + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr>" for cells in rows)
        + "</table>"
        for region, rows in regions
    )
    anchors = "".join(f"<a href='{href}'>{label}</a>" for href, label in links)
    return f"<h1 class='a-size-extra-large'>{title}</h1>{anchors}{tables}"


def release(title, pairs, days):
    sections = "".join(
        f"<div class='a-section a-spacing-none'><span>{k}</span><span>{v}</span></div>" for k, v in pairs
    )
    rows = "".join("<tr>" + "".join(f"<td>{c}</td>" for c in day) + "</tr>" for day in days)
    return (
        f"<h1 class='a-size-extra-large'>{title}</h1>{sections}<table><tr><td>summary</td></tr></table>"
        f"<table><thead><tr><th>Date</th><th>Daily</th></tr></thead><tbody>{rows}</tbody></table>"
    )


YEAR_2024 = listing(
    [
        ("gr1", "Alpha &amp; Omega", "$2,923,706,026", "$1,000", "-"),
        ("gr2", "Beta", "$1,234", "-", "$1,234"),
    ]
)
YEAR_2023 = listing([("gr3", "Gamma", "$77", "$7", "$70"), ("gr4", "", "$5", "-", "$5")])

EUROPE = [
    ("France", "Jan 1, 2024", "$5", "$9"),
    ("Spain", "-", "$7"),
    ("Total", "", "$12", "$16"),
]

PAGES = {
    "/year/world/2024/": YEAR_2024,
    "/year/world/2023": YEAR_2023,
    "/year/world/2022/": listing([("gr9", "Not asked for", "$1", "$1", "-")]),
    "/releasegroup/gr1/": group(
        "Alpha &amp; Omega",
        [("/release/rl9/", "Domestic <i>wide</i>"), ("/release/rl1/?ref_=x", "Domestic")],
        [("EMEA", EUROPE), ("Worldwide", EUROPE)],
    ),
    "/releasegroup/gr2/": group("Beta", [("/release/rl2/", "Domestic release")], []),
    "/releasegroup/gr3/": group("Gamma", [("/release/rl3/", "Original")], [("APAC", EUROPE[:1])]),
    "/releasegroup/gr4/": None,
    "/release/rl1/": release(
        "Alpha &amp; Omega",
        [
            ("Distributor", "ACME See full company information"),
            ("Opening", "$100,262,540 <br> 4,000 theaters"),
            ("Release Date:", "Jan 1"),
            ("Release Date:", "Jan 2"),
            ("Genres", "Action\n\n Drama"),
            ("Widest Release", "4,100 theaters"),
        ],
        [("Jan 1", "$10"), ("Jan 2", "N/A")],
    ),
    "/release/rl2/": release("Beta", [], [("Jan 5", "$1,000")]),
}


def rows(day=DAY):
    return [(path, BASE + path, html, day) for path, html in PAGES.items()]


SCHEMA = "page_key string, url string, html string, fetched_date date"
