"""Texts for the detection of residue, written apart from the exemplars.

FIRST found gaps (languages, cookie walls, network checks) that later exemplars closed in other words, so it is no longer held out.
RESIDUE was written after that, and NEAR had no errors to learn from: no exemplar was made for them. Thresholds were chosen on the
test tables, while both sets were measured beside."""

FIRST = """
This domain has expired. If you are the owner, renew it at your registrar.
The domain parkedsite.example may be for sale. Inquire about buying this domain.
We use cookies to personalise content and ads. By clicking accept, you agree to our use of cookies.
Before you continue, choose whether to accept or reject all cookies.
Please complete the captcha below to continue browsing.
Are you a robot? We have detected unusual traffic from your computer network.
To regain access, please make sure that cookies and JavaScript are enabled before reloading the page.
Our website is being upgraded at the moment. Please visit again in an hour.
We're making some improvements. The site will be back online shortly.
You have read your last free article. Subscribe for unlimited access.
This article is for subscribers only. Log in or subscribe to read on.
Register for free to read this story. Already registered? Log in here.
Страница не найдена. Возможно, она была удалена или перемещена.
Сайт временно недоступен, ведутся технические работы.
Пожалуйста, включите JavaScript в браузере.
お探しのページは見つかりませんでした。
ただいまメンテナンス中です。しばらくお待ちください。
JavaScriptを有効にしてページを再読み込みしてください。
Pagina non trovata. Il contenuto richiesto è stato spostato o rimosso.
Il sito è in manutenzione. Riprova tra qualche minuto.
Per continuare a leggere, abbonati o accedi.
A página solicitada não foi encontrada.
Site em manutenção. Voltamos em breve, tente mais tarde.
De pagina die u zoekt bestaat niet meer.
Sidan du letade efter finns inte längre.
Strona nie została znaleziona. Wróć do strony głównej.
La página solicitada no existe o ha cambiado de dirección.
Lo sentimos, el servicio no está disponible. Vuelva a intentarlo más tarde.
Inicie sesión para ver este contenido.
Désolé, la page que vous recherchez n'existe plus.
Ce service est actuellement en maintenance, merci de réessayer plus tard.
Connectez-vous ou abonnez-vous pour lire cet article.
Die gesuchte Seite existiert leider nicht mehr.
Wegen Wartungsarbeiten ist die Seite zurzeit nicht erreichbar.
Bitte melden Sie sich an, um diesen Artikel weiterzulesen.
找不到您请求的页面。
网站正在维护，请稍后访问。
The page {{ article.body | safe }} was published by {{ article.author }}.
Hi {first_name|default}, your statement for March is ready.
Dear {{ customer.first_name | capitalize }}, we have shipped your parcel.
Dear [Recipient Name], we are writing about your application of [Date].
The board of {{company}} met on Tuesday and approved a dividend.
Profit at ${company_name} rose by a fifth in the year to June.
The bank said <%= quarter %> deposits grew faster than loans.
Ms. [LAST NAME] joins the firm from a rival in Zurich.
The new bridge in %(town)s opens on Monday after two years of work.
Rainfall in {region} was twice the usual amount, farmers said.
The ferry to #{island} was cancelled because of high winds.
The museum will lend @@ARTWORK@@ to a gallery in Vienna.
Shares of undefined closed higher after the ruling.
The yield fell to NaN percent, its lowest since spring.
Total due: #REF! payable within thirty days.
Ticket sales reached #VALUE! in the first week of the run.
Welcome back, [object Object]. Your last visit was on Friday.
The company hired %s engineers in %s and plans to add %d more.
Our head office is at ____________ and the telephone number is ____________.
The lender is [INSERT NAME OF LENDER], a bank incorporated in Denmark.
The closing date shall be [TBD] and the purchase price [●].
Lorem ipsum dolor sit amet, consectetur adipiscing elit. Vivamus sed do magna aliqua.
Sed do eiusmod tempor incididunt ut labore. Ut enim ad minim veniam, quis nostrud exercitation.
Placeholder text. Placeholder text. Placeholder text.
This paragraph is a placeholder. Replace it with your own words.
Your company description goes here.
Enter a title. Enter a subtitle. Enter some text.
Add your own text here. Click to edit.
This is a test post. Please ignore.
testing testing 123
asdf asdf asdf qwerty
Sample page. This is an example page; replace it with your own content.
Hello world! This is your first post. Edit or delete it.
Text to be added before publication.
404 Error: the page could not be found.
Oops, nothing here. The page you requested has been moved or deleted.
The requested resource could not be located on this server.
500 Server Error. Something went wrong while processing your request.
Error 502: bad gateway. The web server is returning an unknown error.
Service unavailable. The server is busy; try again in a few minutes.
Request timed out. Please refresh the page.
An unexpected error occurred. Our team has been notified.
Access to this page has been denied. You do not have permission to view it.
You are not authorized to access this document.
Access denied. Your IP address has been blocked.
Too many requests. Please slow down and try again later.
Sorry, this content is not available in your region.
Your session has timed out for security reasons. Please log in again.
Please log in to your account to view this page.
Enter your username and password to sign in.
Segmentation fault (core dumped)
Fatal error: Out of memory.
Traceback (most recent call last): File "run.py", line 3, in main ValueError: invalid key
Exception in thread "main" java.lang.NullPointerException at Main.main(Main.java:5)
Warning: failed to open stream: No such file or directory in index.php on line 12
Error establishing a database connection
Welcome to nginx! If you see this page, the web server is working.
JavaScript is required to view this site.
You must enable JavaScript in order to use this application.
Your browser does not support JavaScript.
Please upgrade your browser. This site does not support Internet Explorer.
Please disable your ad blocker to continue.
Checking if the site connection is secure. This may take a few seconds.
Verifying you are human. This may take a few seconds.
Please verify that you are not a robot.
Loading... Please wait while the page loads.
Redirecting... If you are not redirected automatically, click here.
This site is under construction. Check back soon.
""".strip().split("\n")

RESIDUE = """
Sorry! This video is private.
The page you tried to open has moved. Use the search box to find it.
We could not find the article. It may have been deleted by its author.
Nothing found here. Return to the homepage.
Error 404. Check the spelling of the address and try again.
HTTP 403: you are not allowed to see this page.
Internal error. Please contact support and quote the reference id.
The server is temporarily unable to service your request.
Oh no! Something broke. We are working on it.
Bad request. Your browser sent an invalid request.
The connection to the database failed.
The upstream server is not responding.
Gateway timeout. Try reloading the page.
This site can't be reached. The server refused the connection.
We are down for maintenance. Thank you for waiting.
Scheduled maintenance in progress. Please come back later.
Our online services are currently unavailable while we upgrade the system.
The new site is launching soon. Stay tuned.
Coming soon! We are building our new website.
This account has been suspended.
Forgot password? Reset it by email.
Please sign in with your username and password.
You have been logged out. Log in again to continue.
Login required. Create a free account to read this page.
Only members can view this content. Become a member.
To continue reading, subscribe or start a free trial.
You've reached your article limit. Subscribe today.
This story is exclusive to subscribers.
Accept cookies to continue.
This site uses cookies. By continuing to browse you accept our cookie policy.
Manage your cookie preferences. Accept all or reject all.
Please turn JavaScript on and reload the page.
JavaScript must be enabled for this application to work.
You need a browser that supports JavaScript.
Scripts are blocked. Allow scripts and refresh.
Enable cookies in your browser settings to log in.
Your browser version is too old. Update your browser.
This page works best in a newer browser.
Ad blocker detected. Please turn it off to read this article.
Confirm you are not a robot to continue.
Please wait while we verify your browser.
One more step: please complete the security check to access this site.
Human verification required. Solve the puzzle.
Unusual activity detected from your network. Access is blocked.
Your IP has been temporarily blocked due to too many requests.
Rate limit exceeded. Retry in sixty seconds.
Unavailable for legal reasons in your country.
This domain is for sale. Contact the owner.
Parked domain. Renew now.
Index of /files. Name, Last modified, Size. Parent Directory
Apache server default page. It works!
Uncaught TypeError: undefined is not a function
RuntimeError: out of memory
panic: runtime error: index out of range
java.io.IOException: connection reset by peer at com.example.Reader.read(Reader.java:44)
{"error": "unauthorized", "message": "invalid token"}
<Error><Code>NoSuchKey</Code><Message>The specified key does not exist.</Message></Error>
Lorem ipsum. Ut labore et dolore magna. Duis aute irure dolor.
Dummy text dummy text dummy text
This is a sample article. Delete it before publishing.
Write your story here.
Paste your text here.
Type a caption.
Insert image caption here.
Your name here. Your address here.
Summary goes here.
Test article. Do not publish.
foo bar baz
blah blah blah
Content to follow.
Página no encontrada. Vuelva a la página de inicio.
Estamos realizando tareas de mantenimiento. Disculpe las molestias.
Debe iniciar sesión para continuar leyendo.
Active las cookies para continuar.
Texto de ejemplo. Sustituya este texto.
Page introuvable. Retour à l'accueil.
Erreur interne du serveur. Veuillez réessayer.
Site en maintenance, revenez plus tard.
Cet article est réservé aux abonnés.
Texte à venir. Insérez votre titre.
Seite nicht verfügbar. Zurück zur Startseite.
Der Server ist zurzeit nicht erreichbar.
Bitte einloggen, um weiterzulesen.
JavaScript ist deaktiviert. Bitte aktivieren Sie es.
Hier Text einfügen.
Pagina inesistente. Torna alla pagina iniziale.
Accesso riservato agli abbonati.
Página inexistente. Volte para a página inicial.
Log in om dit artikel te lezen.
Страница удалена или не существует.
Войдите, чтобы продолжить.
ページは削除されました。
ログインしてください。
页面不存在，请返回首页。
The winner of the {{prize}} is {{winner}}.
Dear Mr. [Last Name], your policy number is [Number].
On <date>, the council of <town> approved the plan.
Turnover of $COMPANY_NAME$ fell by a tenth.
The firm has %d shops in %s.
{% if user %} Hello {{ user.name }} {% endif %}
Net income was null in the second quarter.
The record high of ${temperature} degrees was set in ${year}.
""".strip().split("\n")

NEAR = """
In the mail-merge template, {{name}} stands for the recipient, and each placeholder is filled in when the letters are printed.
The function returned undefined because the program never assigned the variable.
Students fill in the blank ____ in each sentence of the exercise.
The script reads the environment variable ${HOME} to find the configuration file.
In the templating syntax, variables such as {{ title }} are replaced with values by the engine.
The documentation says that the token {user_id} denotes a merge field in the template.
Spreadsheets show #REF! in a cell when its formula refers to a sheet that was deleted.
Format specifiers such as %d and %s tell printf how to print an integer or a string argument.
A typo in the newsletter software showed [FIRST NAME] in the greeting, and the sender apologised.
The ratio is mathematically undefined where the denominator is zero.
The expression evaluates to NaN if either argument of the function is missing.
Jinja and Handlebars both write a variable as {{ value }} in the template.
Lorem ipsum, the filler that printers have used for centuries, comes from a work by Cicero, scholars say.
The designer left lorem ipsum in the brochure, and three thousand copies had to be pulped at a cost of $9,000.
A 404 page costs retailers sales, a study of two hundred shops found, because shoppers seldom return after one.
The minister's website showed an internal server error for most of the day, which the opposition called a disgrace.
Customers of the bank could not log in for six hours on Friday, and the regulator has asked for a report by May.
The newspaper put its articles behind a paywall in 2019 and has since won ninety thousand subscribers.
The regulator fined the website $4 million for setting cookies before visitors had agreed to them.
The company makes software that tells people from robots, and sold its captcha business for $40 million.
Scheduled maintenance at the refinery will cut output by a tenth in May, the operator said.
The museum has been closed for maintenance since January and will reopen in June with a new wing.
Access to the harbour was denied to two ships that had failed an inspection.
The court denied the firm access to the documents, ruling that they were privileged.
The domain name was sold for $1.2 million at an auction held in Lisbon.
Registrars said that renewals of domain names fell for the third year running.
The programme reads one page at a time and keeps the rest on disk, which makes it slow.
JavaScript turned thirty this year; its creator wrote the first version in ten days.
Browsers that block cookies by default now have a third of the market, the survey found.
An ad blocker cut the publisher's revenue by a fifth, its chief executive told investors.
A segmentation fault in the trading engine halted the exchange for an hour, its engineers said.
The error was found by an auditor, who traced it to a database that had been copied by mistake.
The service was unavailable to villages in the north until the line was repaired on Sunday.
Too many requests for refunds arrived at once, the airline said, and staff worked through the night.
The session ended at noon, after members had voted on the budget and two amendments.
The bridge is under construction and should open to traffic in the autumn of next year.
A connection between the two events could not be established by the police.
Please find enclosed the minutes of the meeting held on 4 March and the list of members present.
Press the dough flat, hold the edge with one hand, and tick off the minutes while it rests.
We verify each reading twice, and people check the robot's work before parts leave the plant.
The test of the new engine took three hours, and the text of the report runs to ninety pages.
The page you are holding was printed in 1641 and is one of four that are known to survive.
Subscribers to the concert series get two free tickets and a printed programme.
The account was opened in 2011 and had a balance of 14,200 euros when it was closed.
Sign language is taught at nine schools in the region, up from two a decade ago.
The book's title is to be confirmed, but its author says that it will deal with the war.
Cookies should cool on the tray for five minutes before you move them to a rack.
The manager said the summary would follow in May and the full accounts in June.
Enter the hall by the left door, where the introduction to the exhibition begins.
Analysts called the estimate a placeholder until the audit ends.
The trial is free, but after thirty days the firm charges eleven dollars a month.
Le musée est fermé pour travaux jusqu'au mois de juin, a indiqué la mairie.
Le service des urgences a reçu deux fois plus de malades que l'an dernier.
La session du parlement a expiré sans vote sur le budget, selon le ministre.
Der Dienst am Kunden steht bei dem Händler seit hundert Jahren im Mittelpunkt.
Die Seite der Regierung gewann die Abstimmung mit drei Stimmen Vorsprung.
Wegen Wartungsarbeiten an der Strecke fuhren zwischen Köln und Bonn zwei Wochen lang Busse.
El servicio de trenes entre las dos ciudades volvió a funcionar el lunes.
La página más leída del diario fue la de deportes, según un estudio.
Il museo ha chiuso per manutenzione e riaprirà a giugno con una nuova sala.
A página de esportes do jornal foi a mais lida do ano, segundo a pesquisa.
Страница этой книги была напечатана в Москве в прошлом веке и хранится в музее.
Мэр сообщил, что мост закроют на ремонт до конца июня.
市は来年六月までに新しい橋を建設すると発表した。
公司表示，今年的销售额比去年增长了百分之八。
The set {1, 2, 3} has eight subsets, and the set {a, b} has four.
Footnotes [1] and [2] give the sources; the editor's note [sic] marks a misspelling.
The witness, Mr. [Name withheld], told the inquiry that he had seen two cars.
The index <b>fell</b> 2% and the <i>bond</i> rose.
Prices in tables are in US$ and £; amounts under $1 are shown as a dash.
The record has the form {"id": 7, "name": "Alma"} and is sent once an hour.
In LaTeX the mean is written as $\\bar{x}$ and the variance as $s^2$.
Temperatures of 40 % above the mean were measured, and 100% of stations took part.
The null hypothesis was rejected at the five percent level in four of six trials.
The contract was declared null and void by a court in Antwerp.
None of the directors sold shares in the quarter, and none bought any.
The term is left undefined in the statute, which judges have read in different ways.
She signed the lease as J. Doe & Sons, and he as "the tenant".
The hashtag #budget was used ninety thousand times on the day of the speech.
Send an e-mail to press@bank.example for a copy of the study.
The file is kept under /srv/data/2019 and is copied to a second server each night.
The variable x_1 is the age of the house, and x_2 its distance from the station.
The chemist wrote CO<sub>2</sub> on the board and asked how it forms.
Question: is the plant still for sale? Answer: [laughter] we will tell you when it is sold.
[Applause] Thank you. We will now take questions from the floor.
The minutes record that "the page was intentionally left blank" in the copy sent to the court.
Error bars in the figure show one standard deviation; the gateway in the map is marked in red.
A gateway timeout of thirty seconds was too short for farmers on slow lines, the company found, so it was doubled.
The company's forbidden list names 403 substances that suppliers may not use.
Room 404 was not found by the guests until a porter showed them the way.
The internal auditor and the server of the writ both gave evidence on the second day.
The law requires websites to work without JavaScript if they are run by public bodies.
Enable the pump, wait for a minute and then reload the filter, the manual of the dishwasher says.
Voters must verify their address and confirm that they are citizens when they register.
Most readers skip the introduction, click on a chart and leave within a minute, publishers say.
The city's portal asked for a password that nobody knew, so clerks wrote the permits by hand for a week.
The upgrade of the payments system took longer than planned, and shops lost about two days of sales.
Robots now pick a third of the strawberries, a person who runs the farm said, and people pick the rest.
The team improved the search page, moved the archive to a new address and removed nine thousand dead links.
The museum asked visitors to check back in spring, when the new wing will have been finished.
Only subscribers to the fund may vote, and those who joined after June must wait a year.
Readers wrote that the story was moving, that its title was wrong and that the page had too many adverts.
The bank's app was slow on Monday because its database was being copied, an official said.
""".strip().split("\n")
