"""A crawl over a static corpus, one URL at a time, as the yardstick for the replay."""

from collections import deque


def crawl(seeds, corpus, sites, final_dequeue=True, max_fetches=None):
    """``corpus[url] = (status, content or None, [links])``;
    ``sites[domain] = (set of forbidden URLs, [sitemap URLs])``.

    Returns page states, discovery links and the URLs still queued.
    """
    pages, links, queue = {}, set(), deque()
    visited, contents = set(), {}

    def add(url, parent):
        if url in pages:
            return
        pages[url] = ["FRONTIER", None]
        queue.append(url)
        if parent is not None:
            links.add((parent, url))

    for url in seeds:
        add(url, None)
    while queue:
        url = queue.popleft()
        domain = url.split("/")[2]
        forbidden, located = sites.get(domain, (set(), []))
        if domain not in visited:
            visited.add(domain)
            for other in located:
                add(other, None)
        if url in forbidden:
            pages[url] = ["FORBIDDEN", None]
            continue
        status, content, targets = corpus.get(url, (None, None, []))
        page = pages[url]
        if status is None:
            if not final_dequeue:
                queue.append(url)
        elif status >= 400:
            if page[1]:
                pages[url] = ["HTML", status]
            else:
                pages[url] = ["FRONTIER", status]
                if not final_dequeue:
                    queue.append(url)
        elif content is None:
            pages[url] = ["HTML", status]
        elif contents.setdefault(content, url) != url:
            pages[url] = ["DUPLICATE", status]
        else:
            pages[url] = ["HTML", status]
            for target in targets:
                add(target, url)
    return {u: tuple(p) for u, p in pages.items()}, links


def levels(seeds, edges):
    """Level and parent of every URL in first-in-first-out order."""
    found = {u: (0, None) for u in seeds}
    queue = deque(dict.fromkeys(seeds))
    while queue:
        url = queue.popleft()
        for target in edges.get(url, ()):
            if target not in found:
                found[target] = (found[url][0] + 1, url)
                queue.append(target)
    return found
