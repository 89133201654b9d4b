"""Labelled pages: the article lies between the comments ``content`` and ``/content``.

They teach :mod:`main_text` which elements, class and id names hold something
else than the article, and how often words and tags occur inside and outside
it.  Pages come with and without an element that marks the article.
"""

START, END = "content", "/content"

PAGES = [
    """<!DOCTYPE html><html><head><title>Harbour news</title></head><body class="page">
<header class="site-header masthead"><a href="/">Harbour Gazette</a><p class="tagline">Since 1901</p></header>
<nav class="navbar menu"><ul><li><a href="/a">Home</a></li><li><a href="/b">Sport</a></li></ul></nav>
<div class="cookie consent notice gdpr">We use cookies. <button>Accept</button></div>
<div class="breadcrumb breadcrumbs"><a href="/">Home</a> / <a href="/n">News</a></div>
<main id="main"><article class="post entry"><!--content-->
<header class="entry-header"><h1>Ferry returns after the storm</h1><p class="byline">By Ana Ruiz</p></header>
<p>The ferry <b>left</b> at nine in the morning with forty people and <a href="/x">two lorries</a> on board.</p>
<p>It came back in the evening,<br> an hour late, because the wind had turned again to the north.</p>
<!--/content--><div class="advert ad advertisement ads sponsor sponsored"><p>Buy boots today at half the price</p></div>
<!--content--><h2>What comes next</h2><ul><li>New timetable in May</li><li>A second boat in June</li></ul>
<blockquote><p>We have waited for this, the captain said to us on the pier.</p></blockquote>
<figure><img src="f.png"><figcaption>The pier at dusk</figcaption></figure><!--/content-->
<footer class="entry-footer"><p>Filed under: ships</p></footer>
<div class="share social sharing"><a href="/f">Share this</a></div></article>
<aside class="sidebar related"><h3>Related</h3><ul><li><a href="/r">Old boats</a></li></ul></aside>
<section class="comments comment-list" id="comments"><h3>Comments</h3><article class="comment"><p>I was there and it
was cold, said a reader</p></article><form class="comment-form respond reply"><label>Name</label><textarea></textarea>
<button>Send</button></form></section></main>
<footer class="site-footer footer"><p>Copyright 2020 Harbour Gazette</p></footer></body></html>""",

    """<html><body><div id="page" class="wrapper container"><div class="topbar header banner"><a href="/">The Mill
</a></div><div id="nav" class="navigation nav"><a href="/1">One</a> <a href="/2">Two</a> <a href="/3">Three</a></div>
<div id="content" class="content"><!--content--><h1>A mill by the river</h1><p>The mill was built by two brothers who
came over the hills with one horse and a cart of oak.</p><p>Their wheel still turns on <i>Sundays</i> and
<a href="/h">holidays</a>.</p>
<h2>The stones</h2><p>There are four of them and they weigh a ton each.</p><!--/content-->
<div class="promo promotion newsletter subscribe signup"><p>Sign up to our weekly letter</p><form action="/s"><input>
<select><option>Daily</option></select></form></div>
<!--content--><table><tr><th>Year</th><th>Flour</th></tr><tr><td>1890</td><td>20 tons</td></tr></table>
<pre>wheel: 3 turns a minute</pre><dl><dt>Oak</dt><dd>a hard wood</dd></dl><!--/content-->
<div class="pagination pager"><a href="/p2">Next</a></div></div>
<div id="sidebar" class="widget rail popular trending"><h3>Popular</h3><ul><li><a href="/q">Weirs</a></li></ul></div>
<div class="commentlist discussion responses replies"><p>Lovely place, we went there last year with the children</p></div>
<div id="footer" class="copyright legal disclaimer"><p>All rights reserved. Imprint.</p></div></div></body></html>""",

    """<html><body><div><ul><li><a href="/">Start</a></li><li><a href="/w">Work</a></li><li><a href="/c">Contact</a></li>
</ul></div><div><a href="/en">English</a> <a href="/de">Deutsch</a></div><div><div><!--content--><h1>Bees in the wall</h1>
<p>One summer the bees moved into the wall behind the stove and nobody had the heart to move them out.</p>
<p>By August you could <a href="/s">hear</a> them from
the garden, and at night from the <a href="/l">lane</a>.</p><p>They left in October, all on one day, and we sealed the wall.</p>
<!--/content--></div></div><div><ul><li><a href="/1">Birds</a></li><li><a href="/2">Moths</a></li></ul></div>
<div><a href="/p">Privacy</a> <a href="/t">Terms</a></div></body></html>""",

    """<html><body><div role="banner"><a href="/">Night Sky Club</a></div><div role="navigation"
class="sidenav topnav subnav menubar toc"><a href="/a">Events</a></div><a class="skip skiplink" href="#m">Skip to text</a>
<div role="alert" class="alert announcement notification"><p>The office is closed on Friday.</p></div>
<div class="modal popup overlay dialog paywall" role="dialog"><p>Log in to read more</p></div>
<div role="search" class="search searchbox">Search the club<form><input></form></div>
<div class="aside cookiebar cookiebanner cookieconsent form">Cookies, set yours here</div>
<div role="main" class="story body text" itemprop="articleBody"><!--content--><h1>How to find the bear</h1>
<h2 class="page-header">Begin in the north</h2><p>Look for the seven stars of the plough and follow the two at its end.</p>
<ol><li>Wait for a clear night</li><li>Give your eyes ten minutes</li></ol><p>After that the rest is easy, with a
<a href="/map">map</a> or <strong>without</strong> one.</p>
<!--/content--></div><div role="complementary"><p>Join us on Tuesdays</p></div>
<div role="contentinfo"><p>Night Sky Club, Hill Road</p></div></body></html>""",

    """<html><body><header><h2>Garden Post</h2></header><menu><li>File</li></menu><nav><a href="/">Home</a></nav><article>
<!--content--><h1>Plant garlic late</h1><div class="meta post-header">12 March</div><p>Garlic wants the cold, so put it in
the ground when the leaves have gone and leave it alone until spring.</p><section><h3>Depth</h3><p>Two inches is enough
for most soils.</p></section><!--/content--><aside><p>Our seeds are on offer</p></aside><div class="outbrain taboola
recommended recommendation adsbygoogle adbox adslot banner-ad"><p>You may also like</p></div><!--content--><p>Lift it in
July and dry it in the <em>shade</em>.</p><!--/content--><nav><a href="/n">Next</a></nav><footer><p>Tags: garlic</p></footer>
</article><dialog><p>Welcome</p></dialog><noscript><p>Turn on scripts</p></noscript><template><p>Row</p></template>
<div hidden>Loading</div><svg><text>Logo</text></svg><video>No film here</video><object>None</object>
<canvas>Chart</canvas><audio>No sound</audio><form class="login"><fieldset><legend>Log in</legend><label>User</label><input><button>Go</button>
</fieldset></form><div class="disqus user-comments reader-comments"><p>Mine rotted, what did I do wrong this time</p>
</div><footer><p>Garden Post Ltd.</p></footer></body></html>""",

    """<html><body><table><tr><td><a href="/">Index</a></td><td><a href="/o">Order</a></td></tr></table><div><!--content-->
<h1>Minutes of the bridge committee</h1><p>Present were eleven members and the clerk, who read the letter from the county.
</p><p>The bridge is to be painted <b>green</b>.</p><div>Four tenders came in, and the <a href="/2">second</a> of
them was taken.</div><div><span>Two</span> were late.</div>
<ul><li>Paint: 40 tins</li><li>Brushes: 12</li></ul><p>The meeting closed at nine.</p><!--/content--></div><div><p>
<a href="/h">Help</a> <a href="/s">Site map</a></p></div></body></html>""",
]
