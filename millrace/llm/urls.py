"""URL filters: host and path rules, then logistic regression on hashed character n-grams."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_map, struct

#: Fixed values of the query contract: (host, path prefix) and what they say.
RULES = {("net", "/"): "block", ("example.net", "/en/"): "allow", ("example.com", "/de/"): "block", ("org", "/fr/"): "allow"}

#: The labelled table: hosts of the kinds that block lists name (1), and of well-known public sites (0).
BLOCKED = """
bestonlinecasino.info luckyspin-casino.com royal-slots.net megajackpot.biz pokerbonus24.com slots-vip.co betting-tips-pro.com sportsbet-bonus.net
bet-live-odds.com freebet-offers.info roulette-system.biz bingo-cash.net lotto-winner-claim.com win-a-phone.info prize-claim-now.com youwon-giftcard.top
cheapmeds-online.biz pharmacy-no-rx.com buy-viagra-cheap.net discount-pills.info weightloss-miracle.top keto-pills-now.com hgh-shop.biz replica-watches-sale.com
cheap-handbags-outlet.biz fake-diploma-shop.com buy-followers.top buy-essays-now.com seo-backlinks-cheap.net link-farm-directory.info article-spinner.biz spamlinks.xyz
adserver-click.com ads.trackpixel.net track.clickbank-offers.com popunder-ads.net banner-exchange.biz adtracker.io metrics-pixel.com doubleclick-ads.net
clicktracker.top redirect-offers.xyz affiliate-cash.biz cpa-leads.info adultcams-live.com xxx-videos-free.net hot-singles-near.top porn-tube.xxx
sexchat-now.com escort-directory.biz nude-webcams.net adult-dating-x.com dating-hookup.top payday-loans-fast.com cash-advance-today.biz quick-loan-approved.info
crypto-doubler.top bitcoin-profit-bot.com forex-secret-signals.biz get-rich-quick.info work-from-home-cash.net warez-download.net cracked-software.top keygen-serials.xyz
free-movie-streamz.top torrent-crackz.net account-verify-login.xyz secure-bank-update.top paypal-login-confirm.info free-gift-card.top download-driver-free.biz virus-alert-fix.xyz
""".split()
ALLOWED = """
en.wikipedia.org de.wikipedia.org fr.wiktionary.org commons.wikimedia.org www.britannica.com plato.stanford.edu www.mit.edu www.ox.ac.uk
www.nature.com www.science.org arxiv.org pubmed.ncbi.nlm.nih.gov www.nasa.gov www.noaa.gov www.who.int www.un.org
europa.eu www.gov.uk www.loc.gov www.nps.gov www.bbc.co.uk www.theguardian.com www.nytimes.com www.reuters.com
apnews.com www.lemonde.fr www.spiegel.de www.zeit.de elpais.com www.elmundo.es www.npr.org www.economist.com
github.com gitlab.com stackoverflow.com docs.python.org developer.mozilla.org www.postgresql.org spark.apache.org kernel.org
www.debian.org pypi.org crates.io go.dev www.rust-lang.org numpy.org pandas.pydata.org scikit-learn.org
www.gutenberg.org archive.org openlibrary.org www.poetryfoundation.org www.metmuseum.org www.louvre.fr www.rijksmuseum.nl www.si.edu
www.allrecipes.com www.seriouseats.com www.bonappetit.com www.kingarthurbaking.com www.rhs.org.uk www.gardenersworld.com www.weather.gov www.metoffice.gov.uk
www.khanacademy.org www.coursera.org ocw.mit.edu www.edx.org www.imdb.com www.rottentomatoes.com www.goodreads.com www.librarything.com
www.amazon.com www.ebay.com www.ikea.com www.etsy.com www.nationalgeographic.com www.smithsonianmag.com www.history.com www.lonelyplanet.com
medium.com wordpress.org blog.cloudflare.com blog.google engineering.atspotify.com news.ycombinator.com www.reddit.com www.quora.com
www.mayoclinic.org www.nhs.uk www.cdc.gov www.healthline.com www.sueddeutsche.de www.lefigaro.fr www.abc.es www.dw.com
www.php.net www.behance.net sourceforge.net www.slideshare.net www.speedtest.net www.jstor.org m.youtube.com www.openstreetmap.org
m.imdb.com en.m.wikipedia.org www.cam.ac.uk www.ethz.ch www.sorbonne-universite.fr www.uni-heidelberg.de www.unam.mx www.usp.br
""".split()
#: Paths that the hosts of both kinds take by turns, and some of each kind's own.
PATHS = ("/", "/en/12.html", "/fr/7", "/de/3/", "/es/44", "/index.html", "/page/2", "/about")
OWN_PATHS = (("/2019/05/12/article.html", "/wiki/history", "/docs/guide"), ("/bonus/signup", "/click/7f3a", "/offer/free-spins.html"))

SPLIT = re.compile(r"(?s).*?://([^/?#]*)([^?#]*)")
LOWER = {c: c + 32 for c in range(65, 91)}
BITS = 16
SIZES = (3, 4, 5)


def labelled_urls() -> list[tuple[str, int]]:
    """(url, 1 to block) of the built-in table: each host with two common paths by turns, each third with one of its kind."""
    table = []
    for label, hosts in ((1, BLOCKED), (0, ALLOWED)):
        for i, host in enumerate(hosts):
            paths = [PATHS[i % len(PATHS)], PATHS[(i + 3) % len(PATHS)], *([OWN_PATHS[label][i // 3 % 3]] if i % 3 == 0 else [])]
            table += [(f"https://{host}{path}", label) for path in paths]
    return table


def split(url: str | None) -> tuple[str, str]:
    m = SPLIT.match(url or "")
    return (m[1].translate(LOWER), m[2]) if m else ("", "")


def matching(host: str, path: str, hosts: dict[str, list[str]]) -> tuple[str, str] | None:
    """The longest rule that fits: looked up by each parent of the host, so that rules may be many."""
    best = None
    labels = host.split(".")
    for k in range(len(labels)):
        parent = ".".join(labels[k:])
        for prefix in hosts.get(parent, ()):
            if path.startswith(prefix) and (best is None or (len(parent + prefix), parent) > (len("".join(best)), best[0])):
                best = (parent, prefix)
    return best


def by_host(rules: dict[tuple[str, str], str]) -> dict[str, list[str]]:
    table: dict[str, list[str]] = {}
    for host, prefix in rules:
        table.setdefault(host, []).append(prefix)
    return table


def probability(weights: np.ndarray, host: str, path: str) -> float:
    """That a url is to be blocked."""
    x = features(host, path)
    return float(1 / (1 + np.exp(-(weights[x].sum() / max(1, len(x)) ** 0.5 + weights[-1]))))


def features(host: str, path: str) -> np.ndarray:
    """Distinct buckets of the character n-grams of host and path, each marked as what it is of."""
    out = set()
    for mark, part in (("h", f"^{host}$"), ("p", f"^{path}$")):
        for n in SIZES:
            out.update(zlib.crc32(f"{mark}{part[i : i + n]}".encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1) for i in range(max(0, len(part) - n + 1)))
    return np.fromiter(sorted(out), np.int64, len(out))


def train(table: list[tuple[str, int]] | None = None, rounds: int = 300, rate: float = 0.5, ridge: float = 1e-4) -> np.ndarray:
    """Weights by plain gradient descent, the same for the same table; the last one is the bias.

    The bias is the classes' log-odds in the table and stays: n-grams that it doesn't have say nothing.
    """
    table = table or labelled_urls()
    rows = [(features(*split(url)), y) for url, y in table]
    index = np.concatenate([x for x, _ in rows])
    of = np.repeat(np.arange(len(rows)), [len(x) for x, _ in rows])
    unit = 1 / np.sqrt(np.maximum(1, np.bincount(of, minlength=len(rows))))
    y = np.array([float(v) for _, v in rows])
    w, bias = np.zeros(1 << BITS), np.log((1 + y.sum()) / (1 + len(y) - y.sum()))
    for _ in range(rounds):
        z = np.bincount(of, w[index], len(rows)) * unit + bias
        error = (1 / (1 + np.exp(-z)) - y) / len(rows)
        w -= rate * len(rows) ** 0.5 * (np.bincount(index, (error * unit)[of], 1 << BITS) + ridge * w)
    return np.append(w, bias)


def held_out_accuracy(folds: int = 5) -> float:
    """The built-in table's accuracy on hosts that the model was not trained on."""
    table = labelled_urls()
    fold = {host: k % folds for k, host in enumerate(dict.fromkeys(split(url)[0] for url, _ in table))}
    right = 0
    for f in range(folds):
        weights = train([x for x in table if fold[split(x[0])[0]] != f])
        right += sum((probability(weights, *split(url)) >= 0.5) == (label == 1) for url, label in table if fold[split(url)[0]] == f)
    return right / len(table)


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: dict[tuple[str, str], str] = RULES, table: list[tuple[str, int]] | None = None) -> DataFrame:
    """One row per input row: id, host, path, rule, verdict, score.

    ``score`` is the model's probability that the url is to be blocked; a rule overrules it.
    A null url or one without ``://`` has an empty host and path, and no rule fits it. Null ids
    and repeated rows are judged each on its own; other columns aren't read; an empty table
    gives none. The labelled ``table`` is small: the driver holds it, and only weights are sent.
    """
    schema = struct((id_col, pages.schema[id_col].dataType), ("host", "string"), ("path", "string"), ("rule", "string"), ("verdict", "string"), ("score", "double"))
    sent = pages.sparkSession.sparkContext.broadcast((train(table), rules))

    def rows(batch: pa.RecordBatch) -> list:
        weights, known = sent.value
        hosts_of = by_host(known)
        hosts, paths, fits, verdicts, scores = [], [], [], [], []
        for url in batch.column(1).to_pylist():
            host, path = split(url)
            rule = matching(host, path, hosts_of)
            p = probability(weights, host, path)
            hosts.append(host), paths.append(path), scores.append(p)
            fits.append("".join(rule) if rule else None)
            verdicts.append(known[rule] if rule else "block" if p >= 0.5 else "allow")
        return [batch.column(0), hosts, paths, fits, verdicts, scores]

    return arrow_map(pages.select(id_col, url_col), schema, rows)
