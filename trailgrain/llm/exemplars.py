"""Labelled exemplars of template residue and error pages, one sentence a line.  Numbers and codes are left out."""

#: Anywhere in a title or text.
RESIDUE = """
you need to enable javascript to run this app
please turn on scripts in your browser to see this recipe
this page works only with scripting switched on
this requires javascript and cookies
checking your browser before you continue
javascript is required to view this page
please enable javascript to continue
please enable javascript in your browser
javascript is disabled in your browser
enable javascript and cookies to continue
this site requires javascript to function
veuillez activer javascript pour afficher cette page
bitte aktivieren sie javascript um diese seite anzuzeigen
activa javascript en tu navegador para ver esta página
ative o javascript para ver esta página
attiva javascript per vedere questa pagina
zet javascript aan om deze pagina te bekijken
aktivera javascript för att se den här sidan
ota javascript käyttöön nähdäksesi sivun
włącz javascript aby zobaczyć tę stronę
включите javascript чтобы увидеть страницу
この画面を表示するにはjavascriptを有効にしてください
page not found
the page you asked for has moved or never existed
the page you are looking for does not exist
the requested url was not found on this server
sorry we couldn't find that page
try a search instead
the recipe you were looking for is gone
too many requests
slow down and retry after seconds
the service is unavailable right now
please try again in minutes
service temporarily unavailable
internal server error
bad gateway
gateway timed out
gateway timeout
access denied
your request was blocked by the site owner
you don't have permission to access this resource
database connection could not be made
error establishing a database connection
this account has been suspended
page introuvable
le service est momentanément indisponible réessayez dans minutes
erreur accès refusé dossier
erreur interne du serveur
accès refusé dossier
seite nicht gefunden
die angeforderte adresse gibt es nicht mehr
zugriff verweigert
bitte wenden sie sich an den betreiber
interner serverfehler
página no encontrada
el enlace ya no existe
error interno del servidor
servicio no disponible
página não encontrada
erro no servidor código
o endereço não existe mais
pagina non trovata
errore interno del server
il collegamento non esiste più
pagina niet gevonden
interne serverfout
sidan hittades inte
sidan kunde inte hittas
serverfel kod
försök igen om minuter
sivua ei löytynyt
palvelinvirhe koodi
nie znaleziono strony
strona nie istnieje
błąd serwera
страница не найдена
ссылка больше не работает
ошибка сервера
доступ запрещён
ページが見つかりません
サーバーエラーが発生しました
サーバーエラー、コード
一時的に利用できません
accesso negato
accesso bloccato dal gestore
acceso denegado
demasiadas solicitudes
acesso negado
muitas solicitações
toegang geweigerd
te veel verzoeken
åtkomst nekad
för många förfrågningar
pääsy estetty
palvelu ei ole käytettävissä
brak dostępu
odmowa dostępu
błąd serwera kod
слишком много запросов
ошибка сервера код
сервис временно недоступен
zu viele anfragen
dienst vorübergehend nicht verfügbar
trop de requêtes
アクセスが拒否されました
lorem ipsum dolor
lorem ipsum
recipe name goes here
your text goes here
your title goes here
your content goes here
your headline here
replace this paragraph with your own words
write something about the dish here
type your heading here
insert photo caption two lines at most
enter a short summary of the post in this field
todo write the intro
xxx xxx xxx
this is a sample page
this is an example page
welcome to wordpress this is your first post
add your description here
placeholder text
text kommt noch
blindtext bitte ersetzen
hier steht ihr text
texte d'exemple à remplacer
votre texte ici
saisissez votre texte ici
texto de ejemplo
escribe aquí tu texto
escriba aquí su texto
texto de exemplo
escreva aqui o seu texto
digite seu texto aqui
testo di esempio
inserisci qui il tuo testo
scrivi qui il tuo testo
voorbeeldtekst vervang deze regel
hier komt uw tekst
voorbeeldtekst
exempeltext byt ut
din text här
skriv din text här
esimerkkiteksti
kirjoita tekstisi tähän
tekstisi tähän
przykładowy tekst
wpisz tutaj swój tekst
tutaj wpisz tekst
пример текста
введите ваш текст
здесь будет ваш текст
ここに本文を入力してください
ここに文章を入力
サンプルテキスト
serves undefined
posted undefined ago
makes null portions
per serving null kcal
null g protein
undefined minutes
serves null
makes undefined portions
rated NaN
NaN minutes
NaN oz per serving
NaN
by object object on invalid date
object object
invalid date
missing translation recipe card
warning undefined variable
undefined variable
undefined index
notice missing key
in theme function card meta
fatal error uncaught
uncaught exception
parse error syntax error
traceback most recent call last
stack trace
error loading widget timeout after ms
error loading widget
deprecated function
cannot read properties of undefined
null pointer exception
division by zero in
cannot modify header information headers already sent
""".strip()

#: Only as the whole of a title or line.
WHOLE = """
not found
error
404
403
500
502
503
504
429
410
forbidden
just a moment...
just a moment
sample page
hello world!
hello world
untitled document
untitled
lorem ipsum dolor
undefined
null
new page
test page
attention required
access denied
page not found
service unavailable
bad gateway
fehler
erreur
erro
errore
fout
fel
virhe
błąd
ошибка
エラー
blank page
no title
document
default title
recipe title
""".strip()

#: Looks like residue but belongs to the page: a furniture line about comments.
FINE = """
please enable javascript to view the comments
javascript is needed to load comments
""".strip()

#: Filler is made of these words in any order.
FILLER = """
lorem ipsum dolor sit amet consectetur adipiscing adipisicing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum vestibulum mauris praesent blandit
""".strip()
