"""Labelled exemplars for the detection of residue: short passages in the wording of public notices, one passage each.

Labels: RESIDUE stands in place of content; FRAME surrounds content (menus, marks of the genre); ABOUT is content that speaks of such
notices; UNFILLED shows a slot where a value should stand and EXPLAINED speaks of one (SLOT marks the slot).
"""

SLOT = ""

RESIDUE = (
    # filler, English
    "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore magna aliqua. Ut enim ad minim veniam, quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat. "
    "Duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur. Excepteur sint occaecat cupidatat non proident, sunt in culpa qui officia deserunt mollit anim id est laborum",
    "Your headline goes here. Your subtitle goes here. Your text goes here",
    "Add your title here. Add a summary, caption or short introduction here",
    "Insert the opening paragraph here. Insert body copy, pull quote and chart title here",
    "Click to edit this heading. Tap to add text, subtitle, bio or commentary",
    "Type your own story here. Write a short description, bio or summary about the author or your company in this space",
    "Enter, type or paste your own content in this box or below, then delete this text before publishing",
    "Untitled document. Untitled page. Untitled chart. Untitled presentation",
    "Caption to follow. Summary to come. Commentary coming soon. Headline to be added",
    "Replace this text with your own. Replace this sample paragraph before going live",
    "This is placeholder text. Placeholder copy to be replaced before launch, for design purposes only",
    "This is sample text used to preview the page layout of the template",
    "Dummy text for testing the mock-up. Demo data only. Test article, please ignore. Fake story made up to try out or fill the page",
    "Test test test. Testing one two three. Text text text. This is only a test",
    "asdf asdf qwer qwerty foo bar baz blah blah xyz abc",
    "Sample content, not for publication. Example only; dummy figures to be swapped before release, launch or print",
    "Hello world! Welcome to your new site. This is your first post. Edit or delete it, then start writing",
    "Copy and paste your text into this template and change the headline, introduction, biography and quote",
    "No description available. No content. Content will be added later. This section is intentionally left blank",
    # not found
    "404 Not Found. The requested URL was not found on this server",
    "Page not found. The page you are looking for does not exist, has been moved or is no longer available",
    "Sorry, we can't find that page. The link you followed may be broken or out of date. Check the address for typing errors",
    "Oops! That page can't be found. Try searching or go back to the home page",
    "Error: document not found. The file, article or story you asked for has been removed or deleted",
    "410 Gone. This listing has expired. This account or video is no longer available",
    # server errors
    "500 Internal Server Error. The server encountered an unexpected condition and could not complete your request",
    "502 Bad Gateway. The server received an invalid reply from the upstream host",
    "503 Service Unavailable. The service is temporarily unavailable or down. Please try again later",
    "504 Gateway Timeout. The gateway did not receive a timely response from the upstream server",
    "HTTP status code error, bad request. Your client sent a request that the server could not understand",
    "HTTP Error. Request id, trace id, incident reference, ray id",
    "Something went wrong on our end. An unexpected error has occurred. Refresh the page or contact support",
    "This page isn't working right now. This site can't be reached. The connection was reset or refused",
    "Connection timed out after milliseconds while loading, opening, reading, fetching or getting the page or document",
    "Error establishing a database connection. The database has too many open connections from clients",
    "It works! Apache default welcome page. Welcome to nginx! If you see this page, the web server is successfully installed",
    "Index of directory listing. Parent directory, name, last modified, size",
    # access and limits
    "403 Forbidden. You don't have permission to access this resource, page or document on this server",
    "401 Unauthorized. Access denied. You are not authorized to open or view this file",
    "429 Too Many Requests. Your request rate exceeds the allowed limit or threshold. Slow down and retry later",
    "Automated access from your network is limited or has been blocked. Contact the site owner or administrator if this persists",
    "Sorry, you have been blocked. This website is using a security service to protect itself from online attacks",
    "This content is not available in your country or region, for legal reasons",
    # maintenance
    "The site is down for scheduled maintenance. We will be back shortly. Thank you for your patience",
    "We are performing planned maintenance and upgrades. Services will be restored soon. Please check back later",
    "Under construction. Our new website is coming soon. This service is undergoing maintenance",
    "Please wait and try again shortly or in a few minutes. The system is currently offline",
    # sign-in and walls
    "Your session has expired or timed out. Please sign in or log in again to continue",
    "Sign in to continue. Log in or create an account. Forgot your password? Enter your email address",
    "Subscribe now to continue reading this article. You have reached your limit of free articles this month",
    "Already a subscriber or member? Sign in. This story is for subscribers, registered readers or members only. Registration is required",
    "Start your free trial to get unlimited access. Choose a plan to unlock this content",
    "Incorrect username or password. Verify your email address to activate the account",
    "We use cookies to improve your experience. Accept all cookies, reject or manage preferences and privacy settings",
    "We value your privacy. We and our partners store or access information on a device. Accept and continue, or more options",
    "This domain name is parked or for sale. Buy this domain. The domain owner may renew it at the registrar",
    # errors of programs
    "Traceback (most recent call last): File /usr/lib/app/main.py, line, in module, fetch, load, render, build; return self.body; result = json.loads(response.text); doc = payload[key]; raise",
    "KeyError, ValueError, TypeError, IndexError, AttributeError, TimeoutError, ConnectionResetError, OSError, IOError, RuntimeError, body, html, document, page, article, story",
    "Exception in thread main java.lang.NullPointerException, RuntimeException at com.app.main(Main.java), viewer, render, filing, page, article, quotes, load, build, fetch",
    "Fatal error: Uncaught exception thrown in php on line, call to a member function on null, stack trace, render, viewer, page, article, load",
    "Segmentation fault (core dumped). Aborted. Out of memory: killed process. Kernel panic",
    "Unhandled promise rejection. Uncaught TypeError: Cannot read properties of undefined, is not a function",
    "Warning: Undefined variable, undefined index, failed to open stream: no such file or directory",
    "error code message request failed, invalid or missing key, expired token, not authorized, quota exceeded, body, resource unavailable, upstream timeout, details, trace, status, path, null",
    "Error Code AccessDenied NoSuchKey SlowDown InternalError ExpiredToken Message RequestId HostId",
    # scripts, cookies, browsers, checks
    "Please enable JavaScript (JS) to view this page. Kindly activate or turn on JavaScript and cookies; you need them to continue",
    "JavaScript seems to be disabled, blocked, turned or switched off in your browser. JavaScript and cookies are not available",
    "This site, app, reader or viewer requires JavaScript. It depends on scripts, needs client-side scripting or JS, works only with scripts, and cannot run without them",
    "You must allow, permit, switch or turn on scripts, JS or client-side scripting in your browser settings and reload or refresh to see, read, load or use the interactive document, article, market data or story",
    "If nothing happens, scripts may be blocked by an extension. Loading, please wait. Redirecting you to the page",
    "It looks like an ad blocker, firewall or privacy extension is stopping or blocking this page, document, article or transcript from loading. Please disable it",
    "Your browser is out of date or not supported, and cannot show this page. Use a newer browser, or update it and come back",
    "Your browser blocks content that we need. See the help page for steps to change your settings, and reload when done",
    "Checking your browser before you continue. Just a moment, this may take a few seconds, while we check your connection",
    "Verify, confirm or prove that you are a human and not a robot. Complete the security check in progress below",
    "Press and hold the button, tick the box or solve the captcha or puzzle to confirm that you are a person and reach the site",
    "Select all images with traffic lights. Type the characters you see in the picture to show you are a person. Completing the action only takes seconds",
    "Our systems have detected unusual traffic from your computer network or IP address. Complete the captcha to continue browsing",
    "Make sure that JavaScript and cookies are enabled, and that you are not blocking them, before you reload the page to regain access",
    "This website uses cookies to personalise content and ads, and to analyse traffic. By clicking accept or continuing to browse, you agree to our use of cookies",
    "500 Server Error. Something went wrong while processing your request. An application error occurred on the server; details were logged and the team was notified",
    "This content isn't available right now. It was removed by its owner, is private or was only shared with a few people",
    "Your account has been suspended, locked or disabled. Reset your password. Enter the code sent to your phone",
    "Maintenance mode. The website is briefly unavailable while we update or upgrade. Sorry for the inconvenience",
    "Your connection is not private. Security certificate warning. Proceed or go back to safety. DNS server address could not be resolved",
    "Install or update Flash, a plug-in or the app to view this content. Download the latest version of the browser",
    # Spanish
    "Escriba aquí el título. Inserte aquí su texto. Aquí va el subtítulo, el resumen, la entradilla o la cita",
    "Este es un texto de ejemplo, de relleno o de prueba, sin contenido. Sustituir antes de publicar. Texto simulado",
    "Pie de foto, introducción, biografía o comentario por definir. Titular pendiente",
    "Error 404: no se encontró la página solicitada. La página que busca no existe o ha sido eliminada",
    "El servicio no está disponible en este momento. Estamos en mantenimiento. Inténtelo de nuevo más tarde y recargue la página",
    "Acceso denegado. No tiene permiso. Su sesión ha caducado o expirado, inicie sesión para continuar. Referencia",
    "Active o habilite JavaScript y las cookies en su navegador. Debe permitir los scripts para ver, leer o continuar esta página, la noticia o el visor",
    "Esta aplicación necesita que los scripts estén habilitados y no funciona sin ellos",
    "Espere un momento: estamos comprobando su navegador. Esto tardará unos segundos. Confirme que no es un robot",
    "Suscríbase para seguir leyendo. Este contenido es exclusivo para suscriptores. Usamos cookies, aceptar todas",
    "Lo sentimos, ha ocurrido un error. Vuelva a intentarlo. La dirección no es correcta o el enlace ha cambiado. Volver a la página de inicio",
    "Sitio en mantenimiento, volvemos pronto, disculpe las molestias. Introduzca su usuario y contraseña. Contenido solo para usuarios registrados",
    # French
    "Saisissez votre titre ici. Insérez le texte, la légende ou la citation ici. Écrivez le résumé ou le chapeau ici",
    "Ceci est un faux texte, un exemple de mise en page. Texte de remplissage ou de test, à remplacer avant publication, sans contenu",
    "Sous-titre, introduction, biographie ou commentaire à venir",
    "Erreur 404 : la page demandée est introuvable ou n'existe pas. La page que vous cherchez a été supprimée",
    "Le service est momentanément indisponible. Site en maintenance. Réessayez plus tard ou rechargez la page",
    "Accès refusé ou interdit. Votre session a expiré, connectez-vous de nouveau pour continuer. Référence",
    "Veuillez activer JavaScript et les cookies. Activez ou autorisez les scripts dans votre navigateur, vous devez le faire pour lire, voir, afficher ou continuer cette page ou l'article",
    "Cette application exige ou nécessite l'exécution de scripts. Le site, le lecteur fonctionne uniquement avec JavaScript",
    "Patientez un instant : nous vérifions votre navigateur. Vérification en cours, cela prend quelques secondes. Prouvez que vous n'êtes pas un robot",
    "Abonnez-vous pour lire la suite. Article réservé aux abonnés. Nous utilisons des cookies, tout accepter",
    "Oups, une erreur est survenue. Le lien est erroné ou le contenu n'est plus disponible. Retour à l'accueil, merci de réessayer dans quelques minutes",
    "Le site est actuellement en travaux ou en cours de maintenance, nous revenons bientôt. Saisissez votre identifiant et votre mot de passe",
    # German
    "Hier steht Ihr Titel. Bitte hier Text einfügen oder eingeben. Überschrift, Zusammenfassung oder Zitat hier einfügen",
    "Dies ist ein Blindtext, Platzhalter oder Beispieltext ohne Bedeutung. Der Inhalt wird vor der Veröffentlichung ersetzt. Mustertext, Fülltext oder Testtext für die Einleitung",
    "Bildunterschrift folgt. Text der Meldung und Kommentar folgen noch",
    "Fehler 404: Seite nicht gefunden. Die angeforderte Seite wurde nicht gefunden oder existiert nicht mehr",
    "Der Dienst ist vorübergehend nicht erreichbar. Wartungsarbeiten. Bitte versuchen Sie es später erneut oder laden Sie die Seite neu",
    "Zugriff verweigert. Ihre Sitzung ist abgelaufen, bitte melden Sie sich erneut an. Vorgang, Referenz",
    "Bitte aktivieren Sie JavaScript und Cookies in Ihrem Browser. Sie müssen Skripte erlauben, um diese Seite oder Meldung zu sehen, zu lesen oder fortzufahren",
    "Diese Anwendung funktioniert nur mit eingeschalteten Skripten",
    "Einen Moment bitte, Ihr Browser wird geprüft. Dies dauert nur wenige Sekunden. Bestätigen Sie, dass Sie kein Roboter sind",
    "Jetzt abonnieren und weiterlesen. Dieser Artikel ist nur für Abonnenten. Wir verwenden Cookies, alle akzeptieren",
    "Leider ist ein Fehler aufgetreten. Die gesuchte Seite gibt es nicht mehr oder sie wurde verschoben. Zurück zur Startseite",
    "Wir sind bald wieder für Sie da. Die Website wird gerade gewartet oder überarbeitet. Benutzername und Passwort eingeben",
    # Italian, Portuguese, Dutch, Swedish, Polish
    "Errore 404: pagina non trovata. La pagina richiesta non esiste o è stata rimossa. Torna alla home",
    "Servizio non disponibile. Sito in manutenzione, riprova più tardi. Accesso negato. La sessione è scaduta, accedi di nuovo",
    "Abilita JavaScript e i cookie nel browser per visualizzare questa pagina. Verifica di non essere un robot. Abbonati per continuare a leggere",
    "Inserisci qui il titolo. Testo di esempio o segnaposto da sostituire prima della pubblicazione",
    "Erro 404: página não encontrada. A página que você procura não existe ou foi removida. Voltar ao início",
    "Serviço indisponível. Site em manutenção, tente novamente mais tarde. Acesso negado. Sua sessão expirou, entre novamente",
    "Ative o JavaScript e os cookies no seu navegador para ver esta página. Confirme que você não é um robô. Assine para continuar lendo",
    "Insira aqui o título. Texto de exemplo a ser substituído antes da publicação",
    "Pagina niet gevonden. De gevraagde pagina bestaat niet of is verwijderd. Toegang geweigerd. Probeer het later opnieuw",
    "Schakel JavaScript en cookies in om deze pagina te bekijken. De site is tijdelijk niet beschikbaar wegens onderhoud. Log in om verder te lezen",
    "Sidan kunde inte hittas. Sidan du söker finns inte. Tjänsten är tillfälligt otillgänglig, försök igen senare. Aktivera JavaScript i din webbläsare",
    "Nie znaleziono strony. Strona, której szukasz, nie istnieje. Serwis jest chwilowo niedostępny, spróbuj ponownie później. Włącz JavaScript w przeglądarce",
    "Oops, si è verificato un errore. Il contenuto o la pagina che cerchi è stata spostata o non è più disponibile. Ricarica tra qualche minuto",
    "Accetta tutti i cookie. Registrati o effettua il login per leggere l'articolo completo, riservato agli abbonati",
    "Ops! Ocorreu um erro. O conteúdo foi movido ou não está mais disponível. Voltamos em breve. Faça login ou cadastre-se para ler a matéria exclusiva para assinantes",
    "Er is iets misgegaan. De pagina die u zoekt is verplaatst of niet meer beschikbaar. Ga terug naar de startpagina. Dit artikel is alleen voor abonnees",
    "Något gick fel. Sidan finns inte längre eller har flyttats. Gå till startsidan. Logga in eller bli prenumerant för att läsa vidare",
    "Wystąpił błąd. Strona została usunięta lub przeniesiona. Trwają prace techniczne, wróć na stronę główną. Zaloguj się, aby czytać dalej",
    # Russian, Japanese, Chinese
    "Ошибка 404: страница не найдена. Запрашиваемая страница не существует или была удалена. Вернуться на главную",
    "Сервис временно недоступен. Ведутся технические работы, попробуйте позже. Доступ запрещён. Сессия истекла, войдите снова",
    "Включите JavaScript и cookies в вашем браузере, чтобы продолжить. Подтвердите, что вы не робот. Подпишитесь, чтобы читать дальше",
    "Произошла ошибка. Возможно, страница была перемещена или ссылка устарела. Сайт на обслуживании, скоро вернёмся. Доступно только подписчикам",
    "エラーが発生しました。ページが移動したか、URLが間違っています。トップページへ戻る。会員限定の記事です。",
    "网站正在维护升级，请稍后访问。您请求的内容不存在。出错了。请刷新页面重试。订阅后阅读全文",
    "ページが見つかりません。お探しのページは存在しないか、移動または削除された可能性があります。",
    "現在メンテナンス中です。しばらくしてからもう一度お試しください。サービスは一時的に利用できません。アクセスが拒否されました。",
    "このページを表示するにはJavaScriptを有効にしてください。続きを読むにはログインしてください。",
    "找不到页面。您访问的页面不存在或已被删除。返回首页",
    "系统维护中，请稍后再试。服务暂时不可用。访问被拒绝。请登录后继续阅读",
    "请启用JavaScript和Cookie以继续访问。请完成验证，确认您不是机器人",
)

FRAME = (
    "Home | Markets | Filings | Calls | Sign in",
    "Skip to main content",
    "Menu",
    "Quotes",
    "Watchlist",
    "Newsletters",
    "Share Print Save",
    "Related: most read today",
    "Terms of use.",
    "Privacy notice.",
    "All rights reserved.",
)

ABOUT = (
    "Somebody left lorem ipsum in the deck, an executive joked",
    "Access was denied to the bidders, and the data room page was closed, said a person",
    "The company said its portal no longer tells visitors to enable JavaScript",
    "The chart needs scripts; the table gives the same figures",
    "The page that clients saw read 503 Service Unavailable for minutes, the company said, and orders were queued",
    "Engineers traced the 404 Not Found replies to a routing change",
    "Error rates at the gateway fell after the timeout was raised",
    "Analysts called the guidance a placeholder",
    "The regulator said the outage, during planned maintenance, kept customers from logging in, and fined the bank",
    "The publisher added subscribers after it put articles behind a paywall and limited free articles",
)

UNFILLED = (
    f"Dear {SLOT}, thank you for your order {SLOT}. It will be sent to {SLOT} on {SLOT}",
    f"Shares of {SLOT} rose {SLOT} on {SLOT} after the company named {SLOT} as chief",
    f"The agreement is made on {SLOT} between {SLOT} and {SLOT} for a price of {SLOT} million",
    f"Revenue was {SLOT}, up {SLOT} percent; sales in {SLOT} reached {SLOT} in the quarter ended {SLOT}",
    f"The reporting person owns {SLOT} shares directly at a price of {SLOT} each",
    f"Hello {SLOT}, your account number is {SLOT}. Our office is in {SLOT}. Call us by phone or write by email",
)

EXPLAINED = (
    f"The placeholder {SLOT} is replaced in the template by the mail merge at render time",
    f"Template variables in double curly braces, {SLOT}, are resolved by the templating engine",
    f"The syntax {SLOT} interpolates a variable in Jinja, Handlebars, Mustache, Liquid or a shell script",
    f"The environment variable {SLOT} in your shell or configuration file expands to the home directory",
    f"In the documentation, tokens {SLOT} denote merge fields that users must substitute",
    f"The parser escapes the string {SLOT}; the developers fixed the tag in the code of the library",
    f"The function or method returned {SLOT}, which the program treats as an exception; the expression evaluates to {SLOT}",
    f"The ratio or slope is mathematically {SLOT} where the denominator is zero; the statute leaves the term {SLOT}",
    f"Format specifiers {SLOT} tell printf, the formatter or the logger how to print an integer argument",
    f"Students and respondents fill in the blank {SLOT} in the exercise, quiz, questionnaire or worksheet",
    f"A glitch, bug or typo in the newsletter software showed {SLOT} in the greeting, and the sender apologised",
    f"Spreadsheets show {SLOT} in a cell whose formula refers to a deleted sheet",
    f"The character, symbol or underscore in {SLOT} is a wildcard in file paths and regular expressions",
)

# Marks of transcripts in square brackets.
GENRE_MARKS = ("operator instructions", "indiscernible", "inaudible", "laughter", "applause", "music", "crosstalk", "technical difficulty", "technical difficulties", "foreign language", "audio gap", "break", "sic", "unidentified")

# Names of markup elements, which aren't placeholders.
ELEMENTS = (
    "a", "abbr", "article", "aside", "b", "blockquote", "body", "br", "button", "center", "code", "dd", "div", "dl", "dt", "em", "error", "footer", "font", "form",
    "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hostid", "hr", "html", "i", "iframe", "img", "input", "key", "label", "li", "link", "main", "message", "meta", "nav", "noscript", "ol", "option", "p", "path",
    "pre", "requestid", "resource", "s", "script", "section", "select", "small", "span", "strong", "style", "sub", "sup", "svg", "table", "tbody", "td", "text", "tfoot", "th", "thead", "title", "tr", "u", "ul", "xml",
)
